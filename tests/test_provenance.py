import json

import pytest

from notewright.functions.provenance import ARTICLE_URL, BANK_URL, TRACK_URL
from notewright.operators.lookup import with_source_url
from notewright.sources.lookup import lookup_from_mapping, read_lookup_report, read_lookup_table

CASES = {
    "usmle-12892": BANK_URL + "14366",
    " USMLE-12892\t": BANK_URL + "14366",
    "usmle-1": None,
    "usmle-012892": None,
    "pmc-8696182-3": ARTICLE_URL + "8696182/",
    "PMC-8696182-3 ": ARTICLE_URL + "8696182/",
    "pmc-8696182": None,
    "trec-cds-2014-8": TRACK_URL + "2014.html",
    "trec-ct-2021-10": TRACK_URL + "2021.html",
    "trec-ct-21-10": None,
    "trec-xx-2021-10": None,
    "unknown-1": None,
    "": None,
    None: None,
    "pmc-٣٤-1": ARTICLE_URL + "٣٤/",
}


def sources(spark, lookup):
    notes = spark.createDataFrame([(i, k) for i, k in enumerate(CASES)], "ord bigint, id string")
    return {r["id"]: r["source"] for r in with_source_url(notes, lookup).collect()}


def test_source_urls(spark):
    lookup = spark.createDataFrame([("usmle-12892", 14366)], "key string, row bigint")
    assert sources(spark, lookup) == CASES


def test_without_lookup_bank_ids_have_no_source(spark):
    want = {k: (None if v and v.startswith(BANK_URL) else v) for k, v in CASES.items()}
    assert sources(spark, None) == want


def test_lookup_report(spark, tmp_path):
    blob = {
        "shift": 3,
        "mapping": {
            "USMLE-1": 4, "usmle-1": 5, "usmle-2": "7", "usmle-3": "x", "usmle-4": 3.9, "usmle-5": "3.9",
            "Usmle-6": None, "usmle-7": True, "usmle-8": 1, "USMLE-8": "n/a",
        },
    }
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps(blob, indent=2))
    got = {r["key"]: r["row"] for r in read_lookup_report(spark, str(path)).collect()}
    assert got == {"usmle-1": 5, "usmle-2": 7, "usmle-4": 3, "usmle-7": 1, "usmle-8": 1}
    (tmp_path / "mapping2.json").write_text('{"mapping": {"usmle-2": 8, "usmle-2": 9, "USMLE-9": 1}}')
    got.update({"usmle-2": 9, "usmle-9": 1})
    both = read_lookup_report(spark, f"{tmp_path}/mapping*.json").collect()
    assert {r["key"]: r["row"] for r in both} == got
    with pytest.raises(ValueError, match="too large"):
        read_lookup_report(spark, str(path), max_bytes=10)


def test_lookup_from_the_mapping_table(spark, tmp_path):
    path = str(tmp_path / "mapping")
    spark.createDataFrame([("usmle-9", 2)], "id string, row bigint").write.parquet(path)
    assert [tuple(r) for r in read_lookup_table(spark, path).collect()] == [("usmle-9", 2)]
    assert lookup_from_mapping(spark.read.parquet(path)).columns == ["key", "row"]
