"""Write small TPC-style tables with nulls, ties, duplicate lines and zero
quantities (deterministic per seed) for edge-case oracle runs.

    python tools/edge_fixture.py OUT_DIR [seed]
"""

from __future__ import annotations

import datetime as dt
import os
import random
import sys

import duckdb


def write(out: str, seed: int = 1) -> None:
    rnd = random.Random(seed)
    os.makedirs(out, exist_ok=True)
    orders, lines, parts = [], [], []
    for p in range(1, 16):
        parts.append((p, f"part {p}", rnd.choice(["Brand#1", "Brand#2", "Brand#3", None]), "T", 1,
                      rnd.choice([10.0, 10.0, 25.5, 99.99])))
    n = 1
    for o in range(1, 90):
        cust = rnd.choice([None] + list(range(1, 14)))
        day = None if rnd.random() < 0.05 else dt.datetime(1995, 1, 1) + dt.timedelta(days=rnd.randrange(0, 2400))
        orders.append((o, cust, "F", 1.0, day, "1-URGENT"))
        for _ in range(rnd.randrange(1, 7)):
            part = rnd.choice([None] + list(range(1, 16)) + [3, 3, 3])
            qty = rnd.choice([0.0, 1.0, 2.0, 5.0])
            price = rnd.choice([10.0, 10.0, 20.005, 33.33, 150.0, 400.0])
            line = (o, part, 1, n, qty, price, 0.0, 0.0, rnd.choice(["N", "R", "A"]), rnd.choice(["O", "F"]), day)
            lines.append(line)
            if rnd.random() < 0.1:
                lines.append(line)  # identical line twice
            n += 1
    con = duckdb.connect()
    con.execute("create table orders (o_orderkey bigint, o_custkey bigint, o_orderstatus varchar, o_totalprice double,"
                " o_orderdate timestamp, o_orderpriority varchar)")
    con.executemany("insert into orders values (?, ?, ?, ?, ?, ?)", orders)
    con.execute("create table lineitem (l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber integer,"
                " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
                " l_returnflag varchar, l_linestatus varchar, l_shipdate timestamp)")
    con.executemany("insert into lineitem values (?, ?, ?, ?, ?, ?, ?, ?, ?, ?, ?)", lines)
    con.execute("create table part (p_partkey bigint, p_name varchar, p_brand varchar, p_type varchar, p_size integer,"
                " p_retailprice double)")
    con.executemany("insert into part values (?, ?, ?, ?, ?, ?)", parts)
    for t in ("orders", "lineitem", "part"):
        con.execute(f"copy {t} to '{out}/{t}.parquet' (format parquet)")
    events = []
    props = ['{"k": 1}', '{"k": 2}', '{"k": "7"}', '{"k": {"x": 1}}', '{"k": [1, 2]}', '{"k": null}', '{}', None]
    kinds = ["view", "click", "purchase", "signup", "error", None]
    for e in range(400):
        ts = None if rnd.random() < 0.05 else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 43000))
        value = None if rnd.random() < 0.05 else rnd.choice([0.0, 1.5, 12.31, 99.99])
        events.append((e, ts, rnd.randrange(1, 12), rnd.choice(kinds), value, rnd.choice(props)))
    con.execute("create table events (event_id bigint, ts timestamp, user_id bigint, event_type varchar,"
                " value double, props varchar)")
    con.executemany("insert into events values (?, ?, ?, ?, ?, ?)", events)
    con.execute(f"copy events to '{out}/events.parquet' (format parquet)")
    # the remaining tables are copied from the smallest test set
    for t in ("region", "nation", "customer", "supplier", "documents", "embeddings", "pages",
              "benchmark", "labels", "conversations"):
        con.execute(f"copy (select * from read_parquet('/root/testdata/sf0.001/{t}.parquet')) "
                    f"to '{out}/{t}.parquet' (format parquet)")


if __name__ == "__main__":
    write(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 1)
