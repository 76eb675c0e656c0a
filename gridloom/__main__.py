"""``python -m gridloom FOLDER COMMAND``: search, stats, view, views and export over a folder of curated tables."""

from __future__ import annotations

import argparse
import datetime as dt

from gridloom.api import TABLE_VIEWS, VIEWS, Database
from gridloom.session import local_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridloom")
    p.add_argument("folder")
    commands = p.add_subparsers(dest="command", required=True)
    find = commands.add_parser("search")
    find.add_argument("keyword", nargs="?")
    find.add_argument("--region")
    find.add_argument("--start", type=dt.date.fromisoformat)
    find.add_argument("--end", type=dt.date.fromisoformat)
    find.add_argument("--topic", action="append")
    find.add_argument("--direction", action="append")
    find.add_argument("--official-only", action="store_true")
    find.add_argument("--limit", type=int, default=20)
    commands.add_parser("stats").add_argument("group_by", nargs="+")
    commands.add_parser("views")
    commands.add_parser("view").add_argument("name", choices=[*VIEWS, *TABLE_VIEWS])
    out = commands.add_parser("export")
    out.add_argument("name", choices=[*VIEWS, *TABLE_VIEWS])
    out.add_argument("path")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.command == "views":
        print("\n".join([*VIEWS, *TABLE_VIEWS]))
        return
    db = Database.open(local_session(), args.folder)
    if args.command == "search":
        db.search(args.keyword, args.region, args.start, args.end, args.topic, args.direction, args.official_only, args.limit, False).show(args.limit, truncate=40)
    elif args.command == "stats":
        db.stats(args.group_by).show(1000, truncate=False)
    elif args.command == "view":
        db.view(args.name).show(20, truncate=40)
    else:
        print(db.export(args.name, args.path))


if __name__ == "__main__":
    main()
