"""Rows of flat files that have too few or too many fields."""

import gzip

from polylex.sources import readers


def test_ragged_rows_are_kept_and_counted(spark, tmp_path):
    path = str(tmp_path / "x.tsv.gz")
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write('id\tname\tn\n1\t"a\t5\n2\n3\tc\t7\t8\n\n4\t\t9\n')
    want = [("1", '"a', "5"), ("2", None, None), ("3", "c", "7"), ("4", None, "9")]
    rows = readers.read_tsv(spark, path)
    assert [r[:3] for r in rows.orderBy("pos").collect()] == want
    for some in (["id"], ["n"], ["name", "id"]):  # whatever is read of a row
        assert rows.select("pos", *some).count() == len(rows.select("pos", *some).collect()) == 4
    assert tuple(readers.ragged_rows(spark, path).first())[1:] == (1, 1)


def test_an_empty_table_has_no_ragged_rows(spark, tmp_path):
    path = str(tmp_path / "y.tsv.gz")
    for text in ("id\tname\n", ""):
        with gzip.open(path, "wt") as f:
            f.write(text)
        assert tuple(readers.ragged_rows(spark, path).first()) == (path, 0, 0)
