import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from notewright.llm import chat
from notewright.llm.base import table

SF_DIR = "/root/testdata/sf0.01"


def plain_digests(rows):
    want = {}
    conversations = {}
    for r in rows:
        conversations.setdefault(r["conv_id"], []).append(r)
    for conv, turns in conversations.items():
        turns.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
        said = "".join(f"{r['role'] or ''}\n{r['text'] or ''}\n" for r in turns)
        learned = "".join(r["text"] or "" for r in turns if r["role"] == "assistant")
        want[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                      hashlib.sha256(learned.encode()).hexdigest())
    return want


def got_digests(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


@given(st.text(alphabet="\\#<:>/ ate\n", max_size=30), st.text(alphabet="\\#:< u", max_size=8))
def test_escapes_are_read_back(text, role):
    lead = chat.escape(role).replace(":", "\\:")
    turn = chat.TURN.fullmatch(f"### {lead}: {chat.escape(text)}</turn>\n")
    assert (chat.unescape(turn[1]), chat.unescape(turn[2])) == (role, text)


def test_all_conversations_come_back(spark):
    rows = table(spark, SF_DIR, "conversations")
    assert got_digests(chat.read_back(chat.format_windows(rows))) == plain_digests(rows.collect())


def test_windows_keep_the_budget_and_the_system_turn(spark):
    rows = [(1, 0, "system", "be brief " * 5)]
    rows += [(1, k, "assistant" if k % 2 == 0 else "user", f"turn {k} " * (3 + k % 7)) for k in range(1, 400)]
    rows += [(2, 0, "user", "long " * 500), (2, 1, "assistant", "short")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = chat.format_windows(df, budget=64, history_turns=2, history_tokens=30)
    assert got_digests(chat.read_back(windows)) == plain_digests(df.collect())
    first = [r for r in windows.orderBy("stretch", "window").collect() if r["conv_id"] == 1]
    assert len({r["stretch"] for r in first}) > 1 and len(first) > 20
    for r in first:
        assert r["tokens"] <= 64 and r["text"].startswith("### system: be brief")
        assert all(not r["text"][s["start"]:s["end"]].startswith("###") for s in r["loss"])
    assert any(r["n_repeated"] > 1 for r in first)
    assert sorted(r["tokens"] for r in windows.where("conv_id = 2").collect())[-1] > 64


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 0, "assistant", ""), (1, 0, "assistant", ""),
            (1, 1, "as:sist#ant", "x\\"), (9_007_199_254_740_993, 0, "assistant", "### a: b</turn>\n")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert got_digests(chat.read_back(chat.format_windows(df))) == plain_digests(df.collect())
    assert chat.read_back(chat.format_windows(df.limit(0))).count() == 0


def plain_windows(turns, budget, most_turns, most_tokens, stretch):
    """``turns`` are (role, text, tokens); a window is (repeated, fresh, system left out)."""
    windows, before, border = [], 0, 0
    for k, turn in enumerate(turns):
        new = before // stretch > border
        border, before = before // stretch, before + turn[2]
        if windows and not new:
            repeated, fresh, _ = windows[-1]
            if sum(t[2] for t in repeated + fresh) + turn[2] <= budget:
                fresh.append(turn)
                continue
        systems = [t for t in turns[:k] if t[0] == "system"]
        cut = bool(systems) and systems[-1][2] + turn[2] > budget
        head = systems[-1:] if systems and not cut else []
        left = min(most_tokens, budget - turn[2] - sum(t[2] for t in head))
        history = []
        for old in turns[max(0, k - most_turns):k][::-1]:
            if old[0] != "system":
                if old[2] > left:
                    break
                left -= old[2]
                history.insert(0, old)
        windows.append((head + history, [turn], cut))
    return windows


sizes = st.integers(4, 60)
roles = st.sampled_from(["user", "assistant", "user", "assistant", "system"])


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(roles, sizes), max_size=30), st.integers(5, 70), st.integers(0, 3), st.integers(0, 50))
def test_windows_by_a_plain_rule(turns, budget, most_turns, most_tokens):
    turns = [(role, f"t{k}", n) for k, (role, n) in enumerate(turns)]
    want = plain_windows(turns, budget, most_turns, most_tokens, 10**9)
    now = chat.Formatter((1, 0), None, [], budget, most_turns, most_tokens)
    rows = [row for turn in turns for row in now.add(turn)] + ([now.close()] if turns else [])
    said = lambda window: "".join(f"### {r}: {t}</turn>\n" for r, t, _ in window[0] + window[1])
    assert [(row[3], row[4], row[6]) for row in rows] == [(len(w[0]), w[2], said(w)) for w in want]
    latest = None
    for repeated, fresh, cut in want:
        assert sum(t[2] for t in repeated + fresh) <= budget or (not repeated and len(fresh) == 1)
        assert latest is None or cut or repeated[0] == latest
        latest = next((t for t in fresh[::-1] if t[0] == "system"), latest)


def test_windows_across_stretches_and_with_long_system_turns(spark, monkeypatch):
    monkeypatch.setattr(chat, "STRETCH", 2)
    rows, plain = [], {}
    for conv, (budget_turn, late) in enumerate([(50, 7), (10, 0), (63, 3), (30, 11)]):
        turns = []
        for k in range(60):
            system = k == late or k == late + 20
            role = "system" if system else ("user", "assistant")[k % 2]
            text = " ".join([f"c{conv}k{k}"] * (budget_turn if system else 1 + (k * 7 + conv) % 23))
            turns.append((role, text, len(text.split()) + chat.MARKS))
            rows.append((conv, k, role, text))
        plain[conv] = plain_windows(turns, 64, 2, 30, 2 * 64)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = chat.format_windows(df, budget=64, history_turns=2, history_tokens=30)
    assert got_digests(chat.read_back(windows)) == plain_digests(df.collect())
    found = {}
    for r in windows.orderBy("stretch", "window").collect():
        found.setdefault(r["conv_id"], []).append((r["n_repeated"], r["system_cut"], r["text"]))
    for conv, want in plain.items():
        said = lambda w: "".join(f"### {r}: {t}</turn>\n" for r, t, _ in w[0] + w[1])
        assert found[conv] == [(len(w[0]), w[2], said(w)) for w in want]
