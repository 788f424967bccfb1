import hashlib
import math

import duckdb
import numpy as np
import pytest

from ledgermatch.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, member long, entry string"


def plain(rows, parts=8, entries=16, rounds=6):
    """The contract in Python's integers, a table per length."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for length in {len(r[1]) for r in good}:
        mine = sorted((r for r in good if len(r[1]) == length), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        width = -(-length // parts)
        x = [[max(-(1 << 62), min(1 << 62, math.floor(4096 * float(np.float32(v))))) for v in r[1]] + [0] * (width * parts - length) for r in mine]
        cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in x]
        books = [[v[p] for v in cut[:entries]] for p in range(parts)]
        dist = lambda a, b: sum((i - j) ** 2 for i, j in zip(a, b))
        assign = lambda: [[min((dist(v[p], c), e) for e, c in enumerate(books[p])) for p in range(parts)] for v in cut]
        for _ in range(rounds):
            now = assign()
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [v[p] for v, a in zip(cut, now) if a[p][1] == e]
                    if own:
                        books[p][e] = [sum(c) // len(own) for c in zip(*own)]
        sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
        for r, a in zip(mine, assign()):
            out.append([r[0], "".join(f"{e:02x}" for _, e in a), min(sum(min(d, (1 << 63) - 1) for d, _ in a), (1 << 63) - 1), r[2], sha])
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    return sorted(((a, c, e, min(total[lab], (1 << 63) - 1), s) for a, c, e, lab, s in out), key=str)


def found(df, **how):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vectorcodes.codes(df, **how).collect()), key=str)


def rows_of(n, dim, seed, first=0):
    rng = np.random.default_rng(seed)
    return [(first + i, [float(np.float32(v)) for v in rng.normal(size=dim)], int(i % 5) if i % 7 else None, 1, "c") for i in range(n)]


@pytest.mark.parametrize("owner", [4096, 7])
def test_codes_match_brute_force(spark, owner):
    rows = rows_of(120, 16, 1)
    rows += [(500 + i, rows[3][1], 2, 1, "c") for i in range(60)]  # a vector shared by a third of the rows
    rows += [rows[5], rows[5], (None, rows[9][1], None, 1, "c"), (900, [0.0] * 16, 1, 1, "c")]
    rows += [(901, None, 1, 1, "c"), (902, [None] + [1.0] * 15, 1, 1, "c"), (903, [math.nan] * 16, 1, 1, "c"), (904, [math.inf] * 16, 1, 1, "c")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(df, owner=owner) == plain(rows)


def test_lengths_are_tables_of_their_own(spark):
    rows = rows_of(30, 8, 2) + rows_of(25, 11, 3, 100) + rows_of(3, 3, 4, 200) + [(300, [], None, 1, "c")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_numbers_beyond_doubles_and_longs(spark):
    rows = rows_of(20, 8, 5) + [(50, [1e9, -1e9, 3e4, 5e8, 0.0, 1e12, 1.0, 2.0], 1, 1, "c"), (51, [3e38, -3e38, 1e20, 0.0, 1.0, 2.0, 3.0, 4.0], 1, 1, "c")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_other_sizes_and_empty_table(spark):
    rows = rows_of(40, 12, 6)
    assert found(spark.createDataFrame(rows, SCHEMA), parts=3, entries=5, rounds=2) == plain(rows, 3, 5, 2)
    assert found(spark.createDataFrame(rows, SCHEMA), rounds=0) == plain(rows, rounds=0)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_only_movers_are_shuffled(spark):
    df = spark.createDataFrame(rows_of(200, 16, 7), SCHEMA)
    vectors = vectorcodes.kept(df)
    blocks, books = vectorcodes.lloyd(vectors, rounds=4)
    stepped = vectorcodes.step(blocks, books, 4096)
    moved = stepped.where("moved").agg({"position": "count"}).first()[0]
    assert 0 < moved < stepped.count()  # later rounds keep most blocks
    stays = sum(len(r["members"]) for r in stepped.where("NOT moved").collect())
    assert stays > 0.8 * 200 * 8


def test_the_query_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    want = con.execute(vectorcodes.OP12_SQL)
    names = [d[0] for d in want.description]
    assert sorted(want.fetchall(), key=str) == sorted((tuple(r[c] for c in names) for r in vectorcodes.op12_vectorcodes(spark, small).collect()), key=str)
