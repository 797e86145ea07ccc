"""Structure of conversations judged and repaired by a persistent audit: the cheapest edits, spelled as letters.

Rows are damaged by a hash of their place, judged (blank, duplicate, truncated, illegal neighbours, gaps) and edited
so that their roles read ``(s?(ua)+)?``. A dynamic program keeps for each state of that pattern the cheapest edits so
far. Their letters are a linked list: a node holds one letter and its parent, so prefixes are shared. Nodes also hold
a rolling hash of their letters and binary-lifting ancestors. Of two audits of equal cost the ASCII-least counts: the
longest common prefix is searched by lifting both while their hashes differ, verified letter by letter down to a
shared node, and compared letter by letter if two hashes collided.

A conversation of any length is cut into blocks of bounded rows and bytes. Range partitioning by conversation and
turn makes them, so a conversation that holds a third of all rows is spread. A block's program runs from each state
it may begin in; it returns sixteen costs and, from each state, the order of the audits. A string of edits ends with
a letter that uses up a row, so no audit of a block is a prefix of another from the same state, and the order decides
whatever follows. A second program over the blocks, with the same audits, of which a letter is such an order, picks
the states; each block then writes its piece of the result. Only numbers and digests pass through the task that
chains a conversation's blocks. The pieces are hashed in order as a stream.

Every null counts as one space, in the damage as well as in roles and texts. A conversation's rows go by turn, those
without one first, ties by role and text after the damage. A null ``conv_id`` is a conversation of its own and comes
back as null. Repeated rows are rows of their own. No rows give no conversations. Other columns play no part,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.base import column_rows, ready, row_batches
from notewright.session import scratch_path, settle, shuffle_partitions

MODULUS = 20
DROP, EMPTY, UNSTOP, REPEAT, TO_USER = range(5)
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
SPACE = " \t\n\v\f\r"
STOPS = ".!?"
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}

# States of the pattern: nothing yet, after s, after u, after a. The pattern may end in the first and the last.
BEGIN, SYSTEM, USER, ANSWER = range(4)
NEXT = {BEGIN: "u", SYSTEM: "u", USER: "a", ANSWER: "u"}
AFTER = {"s": SYSTEM, "u": USER, "a": ANSWER}
MAY_END = (BEGIN, ANSWER)

BLOCK_ROWS = 4096
BLOCK_BYTES = 4_000_000
RANGE_PREFIX = 64  # code points of a text that help to cut a conversation into ranges

PRIME = (1 << 61) - 1
BASE = 1_000_003


class Audits:
    """Letters as linked nodes with rolling hashes and binary-lifting ancestors; node 0 is the empty audit."""

    def __init__(self, modulus: int = PRIME) -> None:
        self.modulus = modulus
        self.parent, self.depth, self.letter, self.hash = [0], [0], [0], [0]
        self.up: list[list[int]] = [[0]]

    def add(self, node: int, letter: int) -> int:
        new = len(self.parent)
        depth = self.depth[node] + 1
        self.parent.append(node)
        self.depth.append(depth)
        self.letter.append(letter)
        self.hash.append((self.hash[node] * BASE + letter + 1) % self.modulus)
        lift, k = [node], 0
        while (2 << k) <= depth:
            lift.append(self.up[lift[k]][k])
            k += 1
        self.up.append(lift)
        return new

    def lifted(self, node: int, depth: int) -> int:
        while (step := self.depth[node] - depth) > 0:
            node = self.up[node][step.bit_length() - 1]
        return node

    def compare(self, one: int, two: int) -> int:
        """Below, at or above 0 as the letters of ``one`` stand before, at or after those of ``two``."""
        least = min(self.depth[one], self.depth[two])
        a, b = self.lifted(one, least), self.lifted(two, least)
        if self.hash[a] == self.hash[b]:
            if self.same(a, b):
                return self.depth[one] - self.depth[two]
            return self.plainly(one, two)
        for k in range(self.depth[a].bit_length() - 1, -1, -1):
            # Both have the same depth, so the same ancestors' distances.
            if (1 << k) <= self.depth[a] and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self.letter[a] == self.letter[b] or not self.same(self.parent[a], self.parent[b]):
            return self.plainly(one, two)
        return self.letter[a] - self.letter[b]

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one depth and one hash really agree."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.parent[a], self.parent[b]
        return True

    def letters(self, node: int) -> list[int]:
        found = []
        while node:
            found.append(self.letter[node])
            node = self.parent[node]
        return found[::-1]

    def plainly(self, one: int, two: int) -> int:
        a, b = self.letters(one), self.letters(two)
        return (a > b) - (a < b)


DELETED, INSERTED, KEPT, REROLED = b"DIKR"


class Program:
    """The cheapest audits from one state on, row by row: for each state reached its cost and node."""

    def __init__(self, audits: Audits, begin: int) -> None:
        self.audits = audits
        self.best: dict[int, tuple[int, int]] = {begin: (0, 0)}

    def _offer(self, found: dict, state: int, cost: int, node: int, letters: tuple[int, ...]) -> None:
        held = found.get(state)
        if held is not None and cost > held[0]:
            return
        for letter in letters:
            node = self.audits.add(node, letter)
        if held is None or cost < held[0] or self.audits.compare(node, held[1]) < 0:
            found[state] = cost, node

    def row(self, initial: str, gone: bool, unfinished: bool) -> None:
        """``gone`` rows must be deleted. Insertions stand before rows that stay; before a deletion they would only
        come later in ASCII, and two in a row would lead back to a state that allows the same."""
        found: dict[int, tuple[int, int]] = {}
        late = UNFINISHED if unfinished else 0
        for state, (cost, node) in self.best.items():
            self._offer(found, state, cost + DELETE, node, (DELETED,))
            if gone:
                continue
            if state == BEGIN and initial == "s":
                self._offer(found, SYSTEM, cost + late, node, (KEPT,))
            inserted = AFTER[NEXT[state]]
            for at, more, letters in ((state, 0, ()), (inserted, INSERT, (INSERTED,))):
                wanted = NEXT[at]
                edit, price = (KEPT, 0) if initial == wanted else (REROLED, REROLE)
                self._offer(found, AFTER[wanted], cost + more + price + late, node, (*letters, edit))
        self.best = found


def closing(state: int) -> str:
    """Roles to insert at the end so that the pattern may end."""
    said = ""
    while state not in MAY_END:
        said += NEXT[state]
        state = AFTER[NEXT[state]]
    return said


def _first_fault(text: str, again: bool) -> str:
    said = text.rstrip(SPACE)
    if not said:
        return "blank"
    if again:
        return "duplicate"
    return "" if said[-1] in STOPS else "truncated"


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv, turn, role, text, stays)``: the rows after damage; a dropped one only tells of its conversation."""
    said = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    place = F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        said("role").alias("role"), said("text").alias("text"), F.pmod(F.crc32(place), F.lit(MODULUS)).alias("fate"),
    )
    text = F.when(F.col("fate") == EMPTY, F.lit("")).when(
        F.col("fate") == UNSTOP, F.translate("text", STOPS, "")
    ).when(F.col("fate") == DROP, F.lit("")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == TO_USER, F.lit("user")).otherwise(F.col("role"))
    stays = F.array_repeat(F.col("fate") != DROP, F.when(F.col("fate") == REPEAT, 2).otherwise(1))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(stays).alias("stays"))


BLOCK_DDL = (
    "part int, block int, conv bigint, opens boolean, turns array<bigint>, roles array<string>, texts array<string>, "
    "keys array<binary>"
)
BLOCK = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("conv", pa.int64()), ("opens", pa.bool_()),
    ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("keys", pa.list_(pa.binary())),
])


def in_blocks(rows: DataFrame) -> DataFrame:
    """The rows in order, in blocks of one conversation; ``part`` and ``block`` number them in order.

    ``keys`` has a digest of role and text where a row is the first of its block that says this. ``opens`` is true
    where a block surely begins its conversation."""
    spark = rows.sparkSession
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role")]
    spread = rows.repartitionByRange(shuffle_partitions(spark), *order, F.substring("text", 1, RANGE_PREFIX))
    spread = spread.sortWithinPartitions(*order, "text", "stays")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        n, now, begun, lone, size = 0, None, False, False, 0
        turns: list = []
        roles: list = []
        texts: list = []
        keys: list = []
        seen: set = set()

        def close(opens: bool) -> tuple:
            return part, n, now, opens, list(turns), list(roles), list(texts), list(keys)

        first_run = opens = True
        for conv, turn, role, text, stays in column_rows(batches, "conv", "turn", "role", "text", "stays"):
            other = begun and conv != now
            if other or len(turns) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                yield close(opens)
                n, size, opens = n + 1, 0, other
                for held in (turns, roles, texts, keys, seen):
                    held.clear()
            if not begun:
                opens = False  # the first conversation of a range may have begun in the one before
            now, begun = conv, True
            if not stays:
                continue
            key = hashlib.md5(f"{role}\0{text}".encode()).digest()
            fresh = key not in seen and bool(text.rstrip(SPACE))
            seen.add(key)
            turns.append(turn)
            roles.append(role)
            texts.append(text)
            keys.append(key if fresh else None)
            size += len(text)
        if begun:
            yield close(opens)

    return spread.mapInArrow(lambda batches: row_batches(blocks(batches), BLOCK, 64), BLOCK_DDL)


def first_said(blocks: DataFrame) -> DataFrame:
    """``(part, block, fresh)``: the places in each block of the rows that say something first."""
    each = blocks.select("part", "block", "conv", F.posexplode("keys").alias("at", "key")).where("key is not null")
    # The rows of one key are at most one a block, whatever is repeated.
    first = each.groupBy("conv", "key").agg(F.min(F.struct("part", "block", "at")).alias("first"))
    return first.groupBy("first.part", "first.block").agg(F.collect_list("first.at").alias("fresh"))


class Judged:
    """The rows of one block with their faults."""

    def __init__(self, turns: list, roles: list[str], texts: list[str], fresh: list[int] | None) -> None:
        self.turns, self.roles, self.texts = turns, roles, texts
        first = set(fresh or ())
        self.faults = [_first_fault(text, k not in first) for k, text in enumerate(texts)]

    def run(self, audits: Audits, begin: int) -> Program:
        program = Program(audits, begin)
        for role, fault in zip(self.roles, self.faults):
            program.row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        return program

    def illegal(self) -> int:
        return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(self.roles, self.roles[1:]))


COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct")
LINK_DDL = (
    "part int, block int, conv bigint, costs array<bigint>, ranks array<int>, counts array<bigint>, "
    "first_role string, last_role string, first_turn bigint, last_turn bigint"
)
LINK = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("conv", pa.int64()), ("costs", pa.list_(pa.int64())),
    ("ranks", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64())), ("first_role", pa.string()),
    ("last_role", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
])
NEVER = -1


def linked(part: int, block: int, conv: int | None, opens: bool, judged: Judged) -> tuple:
    """A block as a link of its conversation: cost and order of the audits from each state to each."""
    costs, ranks = [NEVER] * 16, [NEVER] * 16
    for begin in (BEGIN,) if opens else range(4):
        audits = Audits()
        best = judged.run(audits, begin).best
        order = sorted(best, key=cmp_to_key(lambda a, b: audits.compare(best[a][1], best[b][1])))
        for rank, state in enumerate(order):
            costs[4 * begin + state], ranks[4 * begin + state] = best[state][0], rank
    known = [t for t in judged.turns if t is not None]
    counts = [judged.faults.count(name) for name in COUNTS[:3]]
    counts += [judged.illegal(), len(set(known))]
    roles = judged.roles
    return (part, block, conv, costs, ranks, counts, roles[0][:1] if roles else None,
            roles[-1][:1] if roles else None, known[0] if known else None, known[-1] if known else None)


CHAIN_DDL = (
    "part int, block int, begin int, end int, cost bigint, gaps bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint"
)
CHAIN = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())] + [
    (name, pa.int64()) for name in ("cost", "gaps", "blank", "duplicate", "truncated", "illegal")
])


def chained(links: list[tuple]) -> Iterator[tuple]:
    """The states between a conversation's blocks, and with its last block what is found of it as a whole."""
    audits, best = Audits(), {BEGIN: (0, 0)}
    state_of = {0: BEGIN}
    totals = [0] * len(COUNTS)
    least = most = last_role = None
    for _, _, _, costs, ranks, counts, first, last, turn, last_turn in links:
        found: dict[int, tuple[int, int]] = {}
        for begin, (cost, node) in best.items():
            for end in range(4):
                more = costs[4 * begin + end]
                if more == NEVER or (end in found and cost + more > found[end][0]):
                    continue
                new = audits.add(node, ranks[4 * begin + end])
                state_of[new] = end
                if end not in found or cost + more < found[end][0] or audits.compare(new, found[end][1]) < 0:
                    found[end] = cost + more, new
        best = found
        totals = [a + b for a, b in zip(totals, counts)]
        if first is not None:
            totals[3] += last_role is not None and last_role + first not in LEGAL
            last_role = last
        if turn is not None:
            totals[4] -= turn == most
            least, most = turn if least is None else least, last_turn
    end, cost, node = None, None, None
    for state, (spent, at) in best.items():
        whole = spent + INSERT * len(closing(state))
        if cost is None or whole < cost or (whole == cost and audits.compare(at, node) < 0):
            end, cost, node = state, whole, at
    gaps = 0 if least is None else most - least + 1 - totals[4]
    states = [end]
    while node:
        node = audits.parent[node]
        states.append(state_of[node])
    states.reverse()
    for k, link in enumerate(links):
        whole = (cost, gaps, *totals[:4]) if k == len(links) - 1 else (None,) * 6
        yield (*link[:2], states[k], states[k + 1], *whole)


def _runs(rows: Iterable[tuple], place: int) -> Iterator[list[tuple]]:
    """Rows that follow each other with one value at ``place``."""
    held: list[tuple] = []
    for row in rows:
        if held and held[0][place] != row[place]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


PIECE_DDL = (
    "part int, block int, conv bigint, audit string, said string, has boolean, cost bigint, gaps bigint, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)
PIECE = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("conv", pa.int64()), ("audit", pa.string()), ("said", pa.string()),
    ("has", pa.bool_()),
] + [(f.name, f.type) for f in list(CHAIN)[4:]])


def edited(judged: Judged, begin: int, end: int, last: bool) -> tuple[str, list[str]]:
    """The letters of a block's edits, and the repaired rows."""
    audits = Audits()
    letters = audits.letters(judged.run(audits, begin).best[end][1])
    said, state, row = [], begin, 0
    for letter in letters:
        if letter == INSERTED:
            state = AFTER[NEXT[state]]
            said.append(f"{ROLES[NEXT_ROLE[state]]}:")
            continue
        if letter == KEPT:
            state = AFTER[judged.roles[row][:1]]
            said.append(f"{judged.roles[row]}:{judged.texts[row]}")
        elif letter == REROLED:
            said.append(f"{ROLES[NEXT[state]]}:{judged.texts[row]}")
            state = AFTER[NEXT[state]]
        row += 1
    text = bytes(letters).decode()
    for role in closing(state) if last else "":
        text += "I"
        said.append(f"{ROLES[role]}:")
    return text, said


NEXT_ROLE = {USER: "u", ANSWER: "a"}

RESULT_DDL = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
RESULT = pa.schema([("conv_id", pa.int64())] + [
    (name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
] + [("audit", pa.string()), ("repaired_sha256", pa.string())])


def _mapped(df: DataFrame, of: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], schema: pa.Schema, ddl: str,
            size: int = 256) -> DataFrame:
    return df.mapInArrow(lambda batches: row_batches(of(batches), schema, size), ddl)


def repaired_pieces(rows: DataFrame) -> DataFrame:
    """``(part, block, conv, audit, said, has, ...)``: for each block its audit and its repaired rows, newline-joined.

    ``rows`` are ``(conv, turn, role, text, stays)``. ``has`` tells a piece of no rows from one of an empty line.
    The last piece of a conversation also has the counts of it all."""
    spark = ready(rows.sparkSession)
    blocks = settle(in_blocks(rows), scratch_path(spark, "blocks"))
    fresh = settle(first_said(blocks), scratch_path(spark, "fresh"))
    names = ("part", "block", "conv", "opens", "turns", "roles", "texts", "fresh")
    known = blocks.drop("keys").join(fresh, ["part", "block"], "left").select(*names)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part, block, conv, opens, *rest in column_rows(batches, *names):
            yield linked(part, block, conv, opens, Judged(*rest))

    one = settle(_mapped(known, links, LINK, LINK_DDL), scratch_path(spark, "links"))
    # A conversation's links are fixed-width numbers, one for some thousand rows.
    ordered = one.repartition(shuffle_partitions(spark), "conv").sortWithinPartitions("conv", "part", "block")

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for group in _runs(column_rows(batches, *LINK.names), 2):
            yield from chained(group)

    states = settle(_mapped(ordered, chains, CHAIN, CHAIN_DDL), scratch_path(spark, "states"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part, block, conv, turns, roles, texts, fresh_at, begin, end, *whole in column_rows(
            batches, "part", "block", "conv", "turns", "roles", "texts", "fresh", *CHAIN.names[2:]
        ):
            audit, said = edited(Judged(turns, roles, texts, fresh_at), begin, end, whole[0] is not None)
            yield part, block, conv, audit, "\n".join(said), bool(said), *whole

    return _mapped(known.join(states, ["part", "block"]), pieces, PIECE, PIECE_DDL, 16)


def repaired(conversations: DataFrame) -> DataFrame:
    """One row for each conversation: its faults after damage, the cheapest audit and a digest of what it repairs."""
    spark = ready(conversations.sparkSession)
    pieces = repaired_pieces(damaged(conversations))
    pieces = pieces.repartition(shuffle_partitions(spark), "conv").sortWithinPartitions("conv", "part", "block")

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        audits: list[str] = []
        digest, begun = hashlib.sha256(), False
        for conv, audit, said, has, cost, gaps, *counts in column_rows(
            batches, "conv", "audit", "said", "has", "cost", "gaps", *COUNTS[:4]
        ):
            audits.append(audit)
            if has:
                digest.update((("\n" if begun else "") + said).encode())
                begun = True
            if cost is not None:
                yield conv, gaps, *counts, cost, "".join(audits), digest.hexdigest()
                audits, digest, begun = [], hashlib.sha256(), False

    return _mapped(pieces, results, RESULT, RESULT_DDL)
