"""The mapping job against a plain restatement of its rules on small random corpora."""

import random
from collections import Counter, defaultdict

import pytest

from notewright.plans.mapping import REPORT_PARTS, map_notes, run_mapping
from notewright.sources.lookup import read_lookup_table

NOTES = "ord bigint, id string, note string"
BANK = "ord bigint, idx_raw string, question string"


def expected(notes, bank, samples=5):
    questions, bad = defaultdict(list), 0
    for _, raw, question in bank:
        try:
            if question is None:
                raise ValueError
            questions[question].append(int(raw))
        except (TypeError, ValueError):
            bad += 1
    family = [r for r in notes if r[1] and r[1].startswith("usmle-") and r[1][6:].isdigit()]
    by_text = defaultdict(list)
    for _, ident, note in family:
        if note is not None:
            by_text[note].append(ident)
    dropped = [i for ids in by_text.values() for i in ids[1:]]
    rest = [r for r in family if r[1] not in set(dropped)]
    out = {
        "bank": (len(bank), bad), "total": len(notes), "family": len(rest), "dropped": sorted(dropped),
        "groups": {n: ids for n, ids in by_text.items() if len(ids) > 1},
        "mapping": {}, "ambiguous": {}, "missing": [], "shifts": Counter(), "matched": 0, "n_ambiguous": 0,
    }
    for _, ident, note in rest:
        found = questions.get(note) if note is not None else None
        if not found:
            out["missing"].append((ident, "missing description" if note is None else "no matching question"))
            continue
        out["matched"] += 1
        if len(found) > 1:
            out["n_ambiguous"] += 1
            out["ambiguous"][ident] = found
        out["mapping"][ident] = found[0]
        out["shifts"][int(ident[6:]) - found[0]] += 1
    return out


def check(spark, notes, bank, piece=1 << 14):
    want = expected(notes, bank)
    tables = map_notes(
        spark.createDataFrame(notes, NOTES).repartition(3), spark.createDataFrame(bank, BANK).repartition(3),
        piece=piece,
    )
    s = tables.summary.first()
    assert (s["bank_total"], s["bank_missing_fields"]) == want["bank"]
    assert (s["notes_total"], s["family_rows"]) == (want["total"], want["family"])
    assert (s["matched"], s["ambiguous"], s["missing"]) == (
        want["matched"], want["n_ambiguous"], len(want["missing"])
    )
    shifts = {r["shift"]: r["n"] for r in tables.shift_histogram.collect()}
    assert shifts == dict(want["shifts"])
    assert s["shift"] == (next(iter(shifts)) if len(shifts) == 1 else None)
    assert sorted(r["id"] for r in tables.dropped_ids.collect()) == want["dropped"]
    assert {r["id"]: r["row"] for r in tables.mapping.collect()} == want["mapping"]
    assert [tuple(r) for r in tables.missing_samples.collect()] == want["missing"][:5]
    lists = defaultdict(list)
    for r in tables.ambiguous.orderBy("piece").collect():
        lists[r["id"]] += r["candidates"]
    assert lists == want["ambiguous"]
    groups = {bytes(r["key"]): r for r in tables.duplicate_groups.collect()}
    assert {r["note"]: r["n_ids"] for r in groups.values()} == {n: len(i) for n, i in want["groups"].items()}
    members = defaultdict(list)
    for r in tables.duplicate_members.orderBy("piece").collect():
        members[groups[bytes(r["key"])]["note"]] += r["ids"]
    assert members == want["groups"]
    return tables


def random_case(seed):
    rng = random.Random(seed)
    texts = [f"text {i}" for i in range(12)] + [""]
    notes = []
    for at in range(120):
        ident = rng.choice([
            f"usmle-{rng.randrange(60)}", f"usmle-{1000 + at}", f"pmc-{at}-1", "USMLE-5", "usmle-x", "", None
        ])
        notes.append((at * 3, ident, rng.choice([None, "only here", f"own {at}", *texts])))
    bank = [
        (at, rng.choice([str(rng.randrange(90)), "n/a", None, " 7 "]), rng.choice([None, "else", *texts, f"own {at}"]))
        for at in range(80)
    ]
    return notes, bank


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_corpora(spark, seed):
    check(spark, *random_case(seed), piece=50)


def test_one_text_and_one_id_dominate(spark):
    notes = [(i, f"usmle-{i}", "same") for i in range(150)]
    notes += [(200 + i, "usmle-7777", f"t{i}") for i in range(150)]
    notes += [(400 + i, "usmle-8888", None) for i in range(150)]
    bank = [(i, str(i), "same") for i in range(150)] + [(200 + i, str(i + 5), f"t{i}") for i in range(0, 150, 2)]
    check(spark, notes, bank, piece=40)


def test_repeated_id_with_one_text_is_gone(spark):
    notes = [(0, "usmle-1", "a"), (1, "usmle-1", "a"), (2, "usmle-2", "b")]
    tables = check(spark, notes, [(0, "5", "a"), (1, "6", "b")])
    assert [tuple(r) for r in tables.mapping.collect()] == [("usmle-2", 6)]


def test_constant_shift(spark):
    notes = [(0, "usmle-10", "a"), (1, "usmle-20", "b")]
    tables = check(spark, notes, [(0, "7", "a"), (1, "17", "b")])
    assert tables.summary.first()["shift"] == 3


def test_empty_inputs(spark):
    notes = spark.createDataFrame([], NOTES)
    tables = map_notes(notes, spark.createDataFrame([], BANK))
    s = tables.summary.first()
    assert s["notes_total"] == s["family_rows"] == s["matched"] == 0 and s["shift"] is None
    assert tables.mapping.count() == 0


def test_report_is_kept_unless_forced(spark, tmp_path):
    path = str(tmp_path / "report")
    bank = spark.createDataFrame([(0, "5", "a")], BANK)
    first = spark.createDataFrame([(0, "usmle-1", "a")], NOTES)
    second = spark.createDataFrame([(0, "usmle-2", "a")], NOTES)
    read = lambda: [tuple(r) for r in read_lookup_table(spark, f"{path}/mapping").collect()]
    assert run_mapping(first, bank, path) is True
    assert run_mapping(second, bank, path) is False
    assert read() == [("usmle-1", 5)]
    assert run_mapping(second, bank, path, force=True) is True
    assert read() == [("usmle-2", 5)]
    for part in REPORT_PARTS:
        spark.read.parquet(f"{path}/{part}").count()


def test_any_family_number_is_counted(spark):
    big = str(2**63 - 1)
    notes = [(0, f"usmle-{big}", "a"), (1, "usmle-" + "9" * 30, "b"), (2, "usmle-" + "9" * 60, "c"), (3, "usmle-7", "d")]
    bank = [(0, "-5", "a"), (1, "1", "b"), (2, "1", "c"), (3, "3", "d")]
    tables = map_notes(spark.createDataFrame(notes, NOTES), spark.createDataFrame(bank, BANK))
    shifts = {r["shift"]: r["n"] for r in tables.shift_histogram.collect()}
    assert shifts == {2**63 + 4: 1, int("9" * 30) - 1: 1, None: 1, 4: 1}
    summary = tables.summary.first()
    assert summary["matched"] == 4 and summary["shift"] is None


def test_a_shift_that_all_matches_share(spark):
    notes = [(k, f"usmle-{k + 11}", f"text {k}") for k in range(20)]
    bank = [(k, str(k), f"text {k}") for k in range(20)]
    tables = map_notes(spark.createDataFrame(notes, NOTES), spark.createDataFrame(bank, BANK))
    assert tables.summary.first()["shift"] == 11


def test_one_id_with_two_texts_has_the_last_match(spark):
    notes = [(0, "usmle-1", "a"), (1, "usmle-1", "b"), (2, "usmle-2", "c")]
    bank = [(0, "10", "a"), (1, "20", "b"), (2, "30", "c")]
    tables = map_notes(spark.createDataFrame(notes, NOTES), spark.createDataFrame(bank, BANK))
    assert {r["id"]: r["row"] for r in tables.mapping.collect()} == {"usmle-1": 20, "usmle-2": 30}


def test_a_forced_run_that_fails_leaves_no_whole_report(spark, tmp_path, monkeypatch):
    notes = spark.createDataFrame([(0, "usmle-5", "a")], NOTES)
    bank = spark.createDataFrame([(0, "1", "a")], BANK)
    path = str(tmp_path / "report")
    assert run_mapping(notes, bank, path)
    assert not run_mapping(notes, bank, path)
    other = spark.createDataFrame([(0, "2", "a")], BANK)
    from notewright.plans import mapping as plan

    monkeypatch.setattr(plan, "REPORT_PARTS", ("mapping", "no_such_part", "summary"))
    with pytest.raises(AttributeError):
        run_mapping(notes, other, path, force=True)
    monkeypatch.undo()
    assert run_mapping(notes, other, path)
    assert spark.read.parquet(f"{path}/mapping").first()["row"] == 2
    assert spark.read.parquet(f"{path}/summary").first()["shift"] == 3
