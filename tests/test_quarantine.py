"""CSV files with malformed records: none is lost."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tidegauge.sources.quarantine import quarantined

SCHEMA = T.StructType().add("id", "long").add("amount", "double").add("note", "string")
FILES = {
    "a.csv": 'id,amount,note\n1,2.5,fine\n2,x,word for a number\n3,1,one,more\n4\n\n5,,\n6,7,"quoted, with ""both"""\n',
    "b.csv": 'id,amount,note\n7,"8,open\n9,10,after\n',
    "c.csv": "id,amount,note\n",
}


@pytest.fixture()
def raw(tmp_path):
    (tmp_path / "raw").mkdir()
    for name, text in FILES.items():
        (tmp_path / "raw" / name).write_text(text)
    return tmp_path


def test_good_and_bad_rows_are_all_rows(spark, raw):
    found = quarantined(spark, f"{raw}/raw", SCHEMA, f"{raw}/out")
    assert found.good.schema == SCHEMA
    good = sorted(tuple(r) for r in found.good.collect())
    assert good == [(1, 2.5, "fine"), (5, None, None), (6, 7.0, 'quoted, with "both"'), (9, 10.0, "after")]
    assert sorted(r.record for r in found.bad.collect()) == ["2,x,word for a number", "3,1,one,more", "4", '7,"8,open']
    counts = {r.file.rsplit("/", 1)[1]: (r.good, r.bad) for r in found.counts.collect()}
    assert counts == {"a.csv": (3, 3), "b.csv": (1, 1)}
    with pytest.raises(Exception, match="(?i)exist"):
        quarantined(spark, f"{raw}/raw", SCHEMA, f"{raw}/out")


def test_counting_bad_rows_alone_sees_all_faults(spark, raw):
    found = quarantined(spark, f"{raw}/raw", SCHEMA, f"{raw}/out")
    assert found.bad.count() == 4 and found.good.select("id").count() == 4


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,amount,note\n1,2,"two\nlines"\n3,4,plain\n5,x,bad\n')
    found = quarantined(spark, f"{tmp_path}/m.csv", SCHEMA, f"{tmp_path}/out", multi_line=True)
    assert sorted(r.note for r in found.good.collect()) == ["plain", "two\nlines"]
    assert found.bad.count() == 1


def test_refused_names_header_and_path(spark, raw):
    with pytest.raises(ValueError, match="_record"):
        quarantined(spark, f"{raw}/raw", T.StructType.fromDDL("id long, _record string"), f"{raw}/o1")
    with pytest.raises(FileNotFoundError):
        quarantined(spark, f"{raw}/none", SCHEMA, f"{raw}/o2")
    with pytest.raises(Exception, match="(?i)header"):
        quarantined(spark, f"{raw}/raw", T.StructType.fromDDL("key long, amount double, note string"), f"{raw}/o3")
