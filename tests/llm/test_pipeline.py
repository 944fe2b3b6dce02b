"""The registered queries and the pipeline."""

from collections import Counter

import duckdb
import pytest

from tidewire.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import os

    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    found = duck.sql(queries.oracle_sql()[name])
    assert sorted(found.columns) == sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in found.columns) for r in df.collect())
    assert got == Counter(tuple(map(plain, r)) for r in found.fetchall())


def test_registered_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "source mixing", "best-fit packing"]
    now = docs
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns
        sizes.append(now.count())
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3]
    out = corpus_pipeline.run(spark, SF)
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert out.count() == last.count() and out.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()
    per = out.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0]
    assert per <= 1024


def test_pipeline_by_brute_force(spark):
    """Kept ids of the filtering stages, from plain Python."""
    import re
    from collections import defaultdict

    import corpus_pipeline
    from test_operators import fingerprint_brute, least_reachable, lower

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")}
    groups = defaultdict(list)
    for i, t in rows.items():
        groups[lower(t)].append(i)
    rows = {max(ids): rows[max(ids)] for ids in groups.values()}
    ids = sorted(rows)
    least = least_reachable([fingerprint_brute(rows[i]) for i in ids], ids)
    want = {i for i, c in zip(ids, least, strict=True) if i == c}
    now = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, SF)
    assert {r["doc_id"] for r in now.collect()} == want


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    import corpus_pipeline
    from test_operators import ODD, SCHEMA, docs

    texts = [*ODD, *ODD, "ONE", *[f"text number {i} of a few words" for i in range(12)]]
    odd = docs(spark, texts, ids=[None if i == 5 else 3 if i in (3, 4) else i for i in range(len(texts))])
    odd.write.parquet(f"{tmp_path}/odd/documents.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    assert rows and max(used.values()) <= 1024
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
