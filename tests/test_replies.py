"""Replies that are paid for are kept, whatever fails."""

import warnings

import pytest
from pyspark.sql import functions as F

from polylex.operators import crosswalk, providers
from polylex.sources import readers, sinks
from polylex.sources.reply_log import ReplyLog

RECORD = "key string, v int"


def asked(spark, n):
    return spark.range(n).select(F.lit("s").alias("system"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("user"))


def noted(folder, fails=lambda user: False):
    """A provider that notes what it replies to in files, and fails for some."""

    def provider(ask):
        if any(fails(r["user"]) for r in ask):
            raise ValueError("no")
        for r in ask:
            with open(f"{folder}/{r['user']}", "a") as f:
                f.write("x")
        return [r["user"].upper() for r in ask]

    return provider


def test_an_end_half_way_loses_no_committed_wave(spark, tmp_path, monkeypatch):
    (tmp_path / "seen").mkdir()
    cache, waves, append = str(tmp_path / "cache"), [], ReplyLog.append

    def dies(self, records):
        if len(waves) == 3:
            waves.append(None)
            records.write.json(self._name(3, 3))  # what a lost driver leaves: all of it written, nothing committed
            (tmp_path / "cache/run=00000003-00000003/_SUCCESS").unlink()
            raise KeyboardInterrupt
        waves.append(append(self, records))
        return waves[-1]

    monkeypatch.setattr(ReplyLog, "append", dies)
    ask = lambda: providers.ask(asked(spark, 60), noted(tmp_path / "seen"), cache, "m", batch=5, tasks=2, pause=lambda s: None)
    with pytest.raises(KeyboardInterrupt):
        ask()
    kept = readers.read_cache(spark, cache).count()
    assert kept == 30
    waves.extend([None] * 3)
    got = {r.response for r in ask().collect()}
    assert got == {f"U{k}" for k in range(60)}
    times = [len(f.read_text()) for f in (tmp_path / "seen").iterdir()]
    assert len(times) == 60 and sum(times) <= 60 + 10 and max(times) <= 2  # only the wave under way is asked twice
    assert len({r for r in waves if r}) == len([r for r in waves if r])


def test_a_bad_request_does_not_cost_its_batch(spark, tmp_path):
    (tmp_path / "seen").mkdir()
    cache = str(tmp_path / "cache")
    ask = lambda p: providers.ask(asked(spark, 40), p, cache, "m", batch=10, tasks=2, tries=2, pause=lambda s: None)
    with pytest.warns(UserWarning, match="2 requests"):
        got = {r.response for r in ask(noted(tmp_path / "seen", lambda u: u in ("u7", "u31"))).collect()}
    assert got == {f"U{k}" for k in range(40) if k not in (7, 31)} | {None}
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert {r.response for r in ask(noted(tmp_path / "seen")).collect()} == {f"U{k}" for k in range(40)}
    assert {len(f.read_text()) for f in (tmp_path / "seen").iterdir()} == {1}


def test_a_provider_that_is_away_ends_the_asking(spark, tmp_path):
    away = noted(tmp_path, lambda u: True)
    with pytest.raises(RuntimeError, match="3 waves"):
        providers.ask(asked(spark, 50), away, str(tmp_path / "cache"), "m", batch=5, tasks=1, tries=1, pause=lambda s: None)
    short = lambda ask: ["one"]
    got = providers.complete(providers.requests(asked(spark, 3), "m"), short, "m", tries=1, pause=lambda s: None)
    assert sorted(r.response for r in got.collect()) == ["one"] * 3  # too few replies to a batch are none; one by one each has its own


def test_runs_files_and_merging(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = lambda *xs: spark.createDataFrame(xs, RECORD)
    log = ReplyLog(spark, path, RECORD)
    held = lambda: {r.key: r.v for r in log.read().collect()}
    assert held() == {} and log.missing(rows(("a", 0), ("a", 1), (None, 2))).count() == 1
    sinks.append_jsonl(rows(("a", 1), ("b", 1)).coalesce(1), path)  # a cache of plain files
    assert held() == {"a": 1, "b": 1}
    for k in range(12):  # the order of runs is that of numbers
        log.append(rows(("a", 10 + k), (f"k{k}", k)))
    want = {"a": 21, "b": 1} | {f"k{k}": k for k in range(12)}
    assert held() == want
    before = log.read()
    log.merge()
    assert held() == want == {r.key: r.v for r in before.collect()} and len(log._split()[0]) == 1
    log.append(rows(("a", None), (None, 5)))
    want |= {"a": None, None: 5}
    assert held() == want
    log.vacuum()
    assert held() == want and log._split()[1] == [] and len(log._split()[0]) == 2
    log.merge()
    log.vacuum()
    assert held() == want and len(log._split()[0]) == 1


def test_titles_of_a_failing_batch_are_asked_again(spark, tmp_path):
    ids = spark.range(30).select(F.concat(F.lit("CHEBI:"), F.col("id").cast("string")).alias("chebi_id"))
    page = lambda n: (n, f"http://x/entity/Q{n}", f"https://en.x/wiki/T_{n}", "en")

    def some(numbers):
        if "7" in numbers:
            raise TimeoutError
        return [page(n) for n in numbers]

    with pytest.warns(UserWarning, match="5 concepts"):
        got = crosswalk.crosswalk(ids, some, str(tmp_path / "c"), batch=5, wave=2, pause=lambda s: None)
    assert got.count() == 25
    assert crosswalk.crosswalk(ids, lambda ns: [page(n) for n in ns], str(tmp_path / "c"), batch=5).count() == 30


def test_waves_do_not_list_the_runs_before_them(spark, tmp_path, monkeypatch):
    lists, listed = [], ReplyLog._listed
    monkeypatch.setattr(ReplyLog, "_listed", lambda self: lists.append(1) or listed(self))
    counts = []
    for n in (2, 6):
        lists.clear()
        providers.ask(asked(spark, n), lambda ask: [r["user"] for r in ask], str(tmp_path / f"cache{n}"), "m", batch=1, tasks=1)
        assert len(ReplyLog(spark, str(tmp_path / f"cache{n}"), RECORD)._split()[0]) == n
        counts.append(len(lists))
    assert counts[0] == counts[1]
