"""Write a skewed copy of a data folder: a third of all rows gets one order, customer, part, supplier and user.

``python tools/skewed_data.py <folder> <new folder>``. For trials only; the copy is not part of the repository.
"""

from __future__ import annotations

import os
import sys

import duckdb

HOT = {
    "lineitem": (
        "SELECT CASE WHEN hot THEN 7 ELSE l_orderkey END AS l_orderkey, CASE WHEN hot AND n % 2 = 0 THEN 5 ELSE l_partkey END AS l_partkey, "
        "CASE WHEN hot THEN 3 ELSE l_suppkey END AS l_suppkey, CAST(CASE WHEN hot THEN n ELSE l_linenumber END AS INTEGER) AS l_linenumber, "
        "* EXCLUDE (l_orderkey, l_partkey, l_suppkey, l_linenumber, n, hot) FROM (SELECT *, row_number() OVER () AS n, row_number() OVER () % 3 = 0 AS hot FROM {0})"
    ),
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey) FROM {0}",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 4 ELSE user_id END AS user_id) FROM {0}",
}


def main(source: str, target: str) -> None:
    con = duckdb.connect()
    for name in sorted(os.listdir(source)):
        table = f"'{source}/{name}'"
        text = HOT.get(name.removesuffix(".parquet"), "SELECT * FROM {0}").format(table)
        con.execute(f"COPY ({text}) TO '{target}/{name}' (FORMAT parquet, ROW_GROUP_SIZE 20000)")


if __name__ == "__main__":
    main(*sys.argv[1:3])
