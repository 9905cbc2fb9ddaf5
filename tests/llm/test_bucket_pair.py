import hashlib
import random
import struct
import zlib
from collections import Counter
from datetime import date, datetime
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.llm import bucket_pair
from galley.llm.queries import queries
from galley.llm.rowkeys import RowKeys
from tests.helpers import SMALL

SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int"
LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def bits(v):
    """A double's place in the order of doubles."""
    (n,) = struct.unpack(">q", struct.pack(">d", v))
    return n if n >= 0 else -(n & 0x7FFFFFFFFFFFFFFF) - 1


def field(v):
    if v is None:
        return (0,)
    return 1, v.encode() if isinstance(v, str) else bits(v) if isinstance(v, float) else v


def order(row):
    return [(0,) if row[0] is None else (1, -row[0]), *map(field, row[1:])]


def crc(text, n=600):
    return zlib.crc32(text.encode()) % n


def local(path):
    return urlparse(path).path


def brute(sales, lines):
    """(table, bucket) to what is wanted of its file."""
    known = Counter(r[0] for r in sales if r[0] is not None)

    def of(r, lines_):
        return 601 if r[0] is None else 600 if lines_ and r[0] not in known else crc(f"s{r[0]}")

    want = {}
    for name, rows in (("sales", sales), ("sale_lines", lines)):
        flow, files, starts = {}, {}, {}
        for r in rows:
            b = of(r, name != "sales")
            s = (b - 1 if b % 4 == 1 else b) if name == "sales" else 0 if r[2] is None else crc(f"{r[2]}")
            flow.setdefault(b, Counter())[s] += 1
            files.setdefault(b, []).append(r)
            starts.setdefault(s, Counter())[b] += 1
        for b, own in files.items():
            own.sort(key=order)
            ids = ",".join("" if r[0] is None else str(r[0]) for r in own)
            lineage = ",".join(f"{s}:{n}" for s, n in sorted(flow[b].items()))
            stays = len(flow[b]) == 1 and len(starts[next(iter(flow[b]))]) == 1
            joined = sum(known[r[0]] for r in lines if of(r, True) == b) if b < 600 else 0
            want[name, b] = own, len(own), joined, sha(ids), sha(lineage), not stays
    return want


def check(spark, got, sales, lines):
    want = brute([tuple(r) for r in sales.collect()], [tuple(r) for r in lines.collect()])
    got = got.collect()
    assert sorted((r.table_name, r.bucket) for r in got) == sorted(want)
    folders = set()
    for r in got:
        own, *rest = want[r.table_name, r.bucket]
        assert [r.n_rows, r.n_joined, r.ids_sha256, r.lineage_sha256, r.rewritten] == rest
        file = pq.ParquetFile(local(r.path))
        names = (sales if r.table_name == "sales" else lines).columns
        assert r.columns == ",".join(names) and file.schema_arrow.names == names
        found = [tuple(x.values()) for x in file.read().to_pylist()]
        assert [order(x) for x in found] == [order(x) for x in own]
        folders.add(local(r.path).rpartition("/")[0])
    import os

    kept = {f"{d}/{f}" for d in folders for f in os.listdir(d)}
    assert kept == {local(r.path) for r in got}


def test_keys_sort_as_rows_and_come_back(spark):
    rnd = random.Random(5)
    schema = T.StructType.fromDDL("a long, s string, b boolean, i int, y tinyint, f float, d double, t timestamp_ntz, z date, w binary, h smallint")
    draw = {
        "a": lambda: rnd.choice([-(1 << 63), (1 << 63) - 1, -1, 0, 1, rnd.getrandbits(40)]),
        "s": lambda: rnd.choice(["", "\0", "\0\0", "a", "a\0", "a\0b", "é", "\U0001f600", "ab" * 50]),
        "b": lambda: rnd.random() < 0.5,
        "i": lambda: rnd.choice([-(1 << 31), -1, 0, 5, (1 << 31) - 1]),
        "y": lambda: rnd.randint(-128, 127),
        "f": lambda: float(np.float32(rnd.choice([-1.5, 0.0, 2.25, float("inf"), float("-inf")]))),
        "d": lambda: rnd.choice([-1e300, -0.0, 0.0, 1e-300, 2.5, float("inf")]),
        "t": lambda: datetime(2024, 1, rnd.randint(1, 28), 1, 2, 3, rnd.randint(0, 999_999)),
        "z": lambda: date(1960 + rnd.randint(0, 100), 2, 3),
        "w": lambda: rnd.choice([b"", b"\0", b"\xff", b"\0\xff"]),
        "h": lambda: rnd.randint(-300, 300),
    }
    rows = [{k: None if rnd.random() < 0.2 else f() for k, f in draw.items()} for _ in range(600)]
    keys = RowKeys(schema, ("a",))
    batch = pa.RecordBatch.from_pylist(rows, schema=keys.arrow)
    made = keys.encode(batch.columns)
    assert [tuple(map(repr, x)) for x in zip(*(c.to_pylist() for c in keys.decode(made)))] == [tuple(map(repr, r.values())) for r in rows]
    part = keys.decode(made.slice(100, 50))
    assert [c.to_pylist() for c in part] == [c.to_pylist() for c in batch.slice(100, 50).columns]
    by_key = [i for _, i in sorted((k, i) for i, k in enumerate(made.to_pylist()))]

    def place(r):
        return [field(v) if not isinstance(v, bytes) else (1, v) for v in r.values()]

    def down(r):
        first, *rest = place(r)
        return [(first[0], -first[1]) if len(first) > 1 else first, *rest]

    assert [down(rows[i]) for i in by_key] == sorted(map(down, rows))
    with pytest.raises(TypeError):
        RowKeys(T.StructType.fromDDL("a array<int>"))
    with pytest.raises(TypeError):
        RowKeys(schema, ("s",))


def test_query(spark):
    sales, lines = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("sales", "sale_lines"))
    check(spark, queries()["op12_bucketed_pair"](spark, SMALL), sales, lines)


def table_pair(spark, sales, lines):
    sales, lines = spark.createDataFrame(sales, SALES), spark.createDataFrame(lines, LINES)
    b = F.coalesce(bucket_pair.bucket(F.col("sale_id")), F.lit(601))
    start = F.when(b % 4 == 1, b - 1).otherwise(b), F.coalesce(bucket_pair.bucket(F.col("item_id"), salt=""), F.lit(0))
    return sales, lines, bucket_pair.co_bucket(sales, lines, start)


def test_a_hot_sale_is_cut_by_its_bytes(spark):
    """A third of the lines has one sale, many of them are equal; all columns may be null."""
    rnd = random.Random(3)
    at = datetime(2024, 2, 3)
    sales = [(i, i % 7, "done", 1.5 * i, at, None, 1) for i in range(300)] + [(5, 1, None, None, None, None, None)] * 2 + [(None,) * 7] * 3
    lines = [(7, rnd.randint(0, 3), 1, None, 1, -0.5, 0.0, rnd.choice(["a", "a\0b", None]), at) for _ in range(900)]
    lines += [(7, 9, 1, 1, 1, 1.0, 1.0, "same", at)] * 500 + [(None,) * 9] * 4 + [(10_000 + i % 3, 1, None, 1, 1, 1.0, 1.0, "lost", at) for i in range(40)]
    lines += [(rnd.randint(0, 299), i, rnd.randint(0, 5000), 1, 1, 1.0, 1.0, "x", at) for i in range(1500)]
    check(spark, *[(x := table_pair(spark, sales, lines))[2], *x[:2]])


def test_empty_tables(spark):
    assert table_pair(spark, [], [])[2].collect() == []
    sales, lines, got = table_pair(spark, [], [(1, 1, 1, 1, 1, 1.0, 1.0, "x", None)])
    check(spark, got, sales, lines)


def test_cells_hold_a_fair_share(spark):
    rows = spark.createDataFrame([(1, bytes([1, 0, i // 50, i % 50])) for i in range(1000)] + [(2, b"\1same")] * 500 + [(3, b"x"), (4, b"y")], "grp int, key binary").repartition(3)
    of = bucket_pair.cells(rows, {1: 1000, 2: 500, 3: 1, 4: 1}, 15)
    dealt = rows.mapInArrow(bucket_pair._with_part(of), "grp int, key binary, part int").groupBy("part").agg(F.count("*").alias("n"), F.min("grp").alias("g"), F.max("grp").alias("h")).collect()
    # three tasks deal equal rows out, each from the first part on
    assert of.split == {1, 2} and max(r.n for r in dealt) <= 101 + 3 and len(dealt) == of.n_parts
    assert of.starts == sorted(of.starts)
