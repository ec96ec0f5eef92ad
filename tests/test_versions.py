"""A stream against a dictionary that changes, through a restart."""

import random

import pytest

from polylex.operators import linking
from polylex.schema import Config
from polylex.streaming import link_stream, versions

WORDS = [f"w{k}" for k in range(40)]
SHORT = Config(min_alias_len=2)


def keys(spark, *rows):
    return linking.invert(spark.createDataFrame([(c, "en", k, x) for k, (c, x) in enumerate(rows)], "chebi_id string, lang string, pos long, alias string"), SHORT)


def arrive(spark, folder, first, n):
    rng = random.Random(first)
    docs = [(str(k), str(k), "en", " ".join(rng.choice(WORDS) for _ in range(8)) if k % 9 else None) for k in range(first, first + n)]
    df = spark.createDataFrame(docs, link_stream.DOCUMENT)
    df.coalesce(1).write.mode("append").parquet(folder)
    return df


def rows(df):
    return sorted((r.id, tuple(map(tuple, r.mentions)), r.primary_chebi_id) for r in df.collect())


def test_batches_keep_their_version_through_a_restart(spark, tmp_path, monkeypatch):
    folder, dictionaries, out, check = (str(tmp_path / x) for x in ("in", "dictionaries", "out", "check"))
    run = lambda: versions.link_versions(link_stream.read_documents(spark, folder), dictionaries, out, check, SHORT).awaitTermination(120)
    old = keys(spark, ("C1", "w1"), ("C2", "w2"), ("C3", "w2"), ("C4", "w3 w4"))
    new = keys(spark, ("C1", "w1"), ("C2", "w2"), ("C4", "w3 w4"), ("C5", "w5"), ("C6", "w4"))
    docs = arrive(spark, folder, 0, 60)
    with pytest.raises(Exception, match="no version"):
        run()
    assert versions.publish(old, dictionaries) == 1
    run()
    want = lambda df, d: rows(linking.linked_documents(linking.link_exact(df, d, SHORT)))
    assert rows(versions.linked_as_written(spark, out)) == want(docs, old)

    more = arrive(spark, folder, 60, 60)
    real, failed = linking.linked_documents, []

    def fails(linked):
        if not failed:
            failed.append(1)
            versions.publish(new, dictionaries)  # it changes while the batch is under way
            raise RuntimeError("lost")
        return real(linked)

    monkeypatch.setattr(linking, "linked_documents", fails)
    with pytest.raises(Exception, match="lost"):
        run()
    assert versions.linked_as_written(spark, out).count() == 60
    run()
    written = versions.linked_as_written(spark, out)
    assert rows(written) == want(docs.unionByName(more), old)  # by the version that the batch began with, each document once
    last = arrive(spark, folder, 120, 30)
    run()
    assert {(r.version, r["count"]) for r in versions.linked_as_written(spark, out).groupBy("version").count().collect()} == {(1, 120), (2, 30)}
    every = docs.unionByName(more).unionByName(last)
    assert rows(versions.linked_now(spark, dictionaries, out, SHORT)) == want(every, new)
