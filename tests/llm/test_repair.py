import hashlib
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from notewright.llm import repair
from notewright.llm.base import table

SF_DIR = "/root/testdata/sf0.01"
SPACES = " \t\n\v\f\r"
ROLE = {"u": "user", "a": "assistant"}


def plain_audit(rows):
    """All edits by a table of cost and whole strings, with up to two insertions anywhere."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        found = dict(best)
        for _ in range(2):
            for state, (cost, edits, said) in list(found.items()):
                for letter in "ua":
                    new = after.get((state, letter))
                    offer = (cost + 5, edits + "I", [*said, ROLE[letter] + ":"])
                    if new is not None and (new not in found or offer[:2] < found[new][:2]):
                        found[new] = offer
        return found

    best = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        found = {}

        def offer(state, cost, edits, said):
            if state not in found or (cost, edits) < found[state][:2]:
                found[state] = (cost, edits, said)

        late = 5 if fault == "truncated" else 0
        for state, (cost, edits, said) in best.items():
            offer(state, cost + 2, edits + "D", said)
            if fault in ("blank", "duplicate"):
                continue
            if (state, role[:1]) in after:
                offer(after[state, role[:1]], cost + late, edits + "K", [*said, f"{role}:{text}"])
            for letter in "ua":
                if (state, letter) in after and letter != role[:1]:
                    offer(after[state, letter], cost + 1 + late, edits + "R", [*said, f"{ROLE[letter]}:{text}"])
        best = inserted(found)
    return min(best[state] for state in ("", "a") if state in best)


def plain_results(rows):
    """``rows`` are (conv_id, turn, role, text)."""
    conversations = {}
    for conv, turn, role, text in rows:
        held = conversations.setdefault(conv, [])
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(place.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        held += [(turn, role, text)] * (2 if fate == 3 else 1)
    want = {}
    for conv, held in conversations.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for _, role, text in held:
            said = text.rstrip(SPACES)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else (
                "" if said[-1] in ".!?" else "truncated")
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [r[0] for r in held if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for _, _, f in judged]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit, said = plain_audit(judged)
        want[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost,
                      audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return want


def got_results(df):
    rows = df.collect()
    found = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.sampled_from(["", "", "blank", "truncated"])),
                max_size=9), st.integers(0, 9))
def test_blocks_against_plain_strings(rows, cut):
    """Any cut into two blocks gives the cheapest, ASCII-least audit of the whole."""
    rows = [(role, f"t{k}", fault) for k, (role, fault) in enumerate(rows)]
    cost, audit, said = plain_audit(rows)
    parts = [p for p in (rows[:cut], rows[cut:])]
    judged = []
    for part in parts:
        one = repair.Judged([None] * len(part), [r for r, _, _ in part], [t for _, t, _ in part], [])
        one.faults = [f for _, _, f in part]
        judged.append(one)
    links = [repair.linked(0, k, 1, False, j) for k, j in enumerate(judged)]
    chain = list(repair.chained(links))
    pieces = [repair.edited(j, c[2], c[3], c[4] is not None) for j, c in zip(judged, chain)]
    assert (chain[-1][4], "".join(p[0] for p in pieces)) == (cost, audit)
    assert [line for p in pieces for line in p[1]] == said


@given(st.lists(st.lists(st.integers(0, 1), max_size=12), min_size=2, max_size=6), st.sampled_from([3, 7, repair.PRIME]))
def test_audits_compare_even_when_hashes_collide(words, modulus):
    audits = repair.Audits(modulus)
    nodes = []
    for word in words:
        node = 0
        for letter in word:
            node = audits.add(node, letter)
        nodes.append(node)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            order = audits.compare(nodes[i], nodes[j])
            assert (order > 0) - (order < 0) == (a > b) - (a < b)


def test_all_conversations(spark):
    rows = table(spark, SF_DIR, "conversations")
    want = plain_results([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows.collect()])
    assert got_results(repair.repaired(rows)) == want


def test_long_conversations_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 7)
    roles = ["user", "assistant", "system", "admin", "tool", "user"]
    rows = [(1, k // 3 * 2, roles[k * k % 6], f"line {k % 50}" + ".!? "[k % 4]) for k in range(700)]
    rows += [(k, 0, "user", "same text.") for k in range(2, 60)]
    rows += [(77, k % 2, "assistant", "again!") for k in range(40)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert got_results(repair.repaired(df)) == plain_results(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a."), (None, None, None, None), (1, None, None, None), (1, None, "user", "x."),
            (1, 0, "assistant", ""), (1, 0, "assistant", ""), (1, 1, "as:sist\nant", "x\\?"), (2, 5, "", "."),
            (9_007_199_254_740_993, 3, "assistant", "wort " * 50_000 + "!"), (3, 2, "user", " "),
            (-4, -9, "user", "hm?"), (-4, 3, "assistant", "ja.")]
    rows += [(100 + k, 0, "user", "only row") for k in range(60)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, part int, key string")
    want = plain_results(rows)
    assert any(v[5] == 0 and v[6] == "" for v in want.values())  # a conversation that lost its only row
    assert got_results(repair.repaired(df)) == want
    assert repair.repaired(df.limit(0)).count() == 0
