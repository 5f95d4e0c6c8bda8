"""Run the road accident study: ``python -m rowlens RAW_FOLDER OUTPUT_FOLDER``.

Writes every result table below the output folder as Parquet and shows the short ones.
"""

from __future__ import annotations

import sys

from rowlens.plans import accidents, study
from rowlens.session import build_session, owned_tables
from rowlens.sources.files import scan_parquet, write_parquet


def main(raw: str, output: str) -> None:
    spark = build_session("road accidents")
    parent, children = accidents.read_tables(spark, raw)
    with owned_tables(spark):
        for title, table in study.run(accidents.ROAD_ACCIDENTS, parent, children).items():
            path = f"{output.rstrip('/')}/{title.replace(' ', '_').replace('/', '-')}"
            write_parquet(table, path)
            if title != "prepared":
                print(title)
                scan_parquet(spark, path).show(30, truncate=False)


if __name__ == "__main__":
    main(*sys.argv[1:3])
