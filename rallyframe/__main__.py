"""``python -m rallyframe scrape|documents|index``: runs on a session that ``spark-submit`` or the environment sets up."""

from __future__ import annotations

import argparse

from .operators.refresh import LIST_PAUSE, NEWS_PAUSE


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("rallyframe")
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("scrape", "documents", "index"):
        c = commands.add_parser(name)
        c.add_argument("path", help="folder of stored documents")
        if name != "index":
            c.add_argument("--landing", required=True, help="shared folder for answers")
            c.add_argument("--url", required=True, help="address of the service")
            c.add_argument("--origin", default="")
            c.add_argument("--every", type=float, default=LIST_PAUSE if name == "scrape" else NEWS_PAUSE, help="seconds between calls, over all tasks")
            c.add_argument("--callers", type=int, default=1, help="tasks that call")
        if name == "scrape":
            c.add_argument("--live-url", required=True, help="address of items and matches")
            c.add_argument("--draw-base", default=None)
            c.add_argument("--full", action="store_true", help="fetch all tournaments")
        if name == "documents":
            c.add_argument("--force", action="store_true", help="fetch finished ones too")
    return p


def main(arguments: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    from .operators import indexes, refresh
    from .sources import read_stored, write_indexes

    a = parser().parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    if a.command == "scrape":
        refresh.scrape(spark, a.path, a.url, a.live_url, a.landing, a.full, a.draw_base, every=a.every, callers=a.callers, origin=a.origin).show()
    elif a.command == "documents":
        refresh.attach_documents(spark, a.path, a.url, a.landing, a.force, every=a.every, callers=a.callers, origin=a.origin).show()
    else:
        tables = indexes.build(read_stored(spark, a.path))
        write_indexes(tables, f"{a.path}_index")
        indexes.sizes(tables).show()


if __name__ == "__main__":
    main()
