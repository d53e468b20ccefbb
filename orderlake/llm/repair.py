"""Conversation structure repair by a dynamic programme over persistent audit trails.

A conversation must read ``(system? (user assistant)+)?``.  Row by row the
programme keeps, for each of the four states of that pattern, the cheapest
edits so far.  Their audit string is not copied: it is a node that names its
last edits and its parent, so all candidates share their prefixes.  Nodes know
their ancestors 1, 2, 4, ... steps up and a rolling hash of the whole string,
so two equally cheap strings are compared by a search for their longest common
prefix; equal hashes of different nodes are verified character by character.

Conversations of up to ``block`` rows are one task's group.  Longer ones are
cut into blocks of rows: each block is solved alone from all four states, a
second step joins the blocks' results (again with audit trails, whose nodes
then hold a block's string), and a third gives each row its edits.  No task
holds more than a block of rows, or four audit strings, of one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import SPACES, checkpoint, groups, map_arrow, per_key

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of a conversation that a task solves at once.
BLOCK = 2048
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.  Only the first and last may end.
STATES, ENDS = range(4), (0, 3)
_STEP = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}
_ROLE = {2: "user", 3: "assistant"}
_BASE, _MOD = 1_000_003, (1 << 61) - 1


class Trails:
    """Persistent strings: node 0 is empty, any other is its parent and a piece (one or more characters)."""

    def __init__(self, base: int = _BASE, mod: int = _MOD):
        self.base, self.mod = base, mod
        self.piece, self.length, self.hash, self.up = [""], [0], [0], [()]
        self.same: dict[tuple[int, int], int] = {}

    def _rolled(self, h: int, text: str) -> int:
        for c in text:
            h = (h * self.base + ord(c)) % self.mod
        return h

    def add(self, parent: int, piece: str) -> int:
        """A new node; its ancestors are 1, 2, 4, ... steps up."""
        up, a, j = [parent], parent, 0
        while j < len(self.up[a]):
            a = self.up[a][j]
            up.append(a)
            j += 1
        self.piece.append(piece)
        self.length.append(self.length[parent] + len(piece))
        self.hash.append(self._rolled(self.hash[parent], piece))
        self.up.append(tuple(up))
        return len(self.piece) - 1

    def holder(self, node: int, n: int) -> int:
        """The topmost ancestor-or-self whose string has at least n characters."""
        length, up = self.length, self.up
        for j in range(len(up[node]) - 1, -1, -1):
            while j < len(up[node]) and length[up[node][j]] >= n:
                node = up[node][j]
        return node

    def prefix_hash(self, node: int, n: int) -> int:
        if not n:
            return 0
        h = self.holder(node, n)
        if self.length[h] == n:
            return self.hash[h]
        parent = self.up[h][0]
        return self._rolled(self.hash[parent], self.piece[h][: n - self.length[parent]])

    def char(self, node: int, i: int) -> str:
        h = self.holder(node, i + 1)
        return self.piece[h][i - self.length[self.up[h][0]]]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.piece[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix."""
        low, high = 0, min(self.length[a], self.length[b])
        while low < high:
            mid = (low + high + 1) // 2
            if self.prefix_hash(a, mid) == self.prefix_hash(b, mid):
                low = mid
            else:
                high = mid - 1
        return self._verified(a, b, low)

    def _verified(self, a: int, b: int, n: int) -> int:
        """n if the first n characters are equal indeed (found from the end up to a shared node), else the true common length."""
        x, y = self.holder(a, n) if n else 0, self.holder(b, n) if n else 0
        i, seen, differ = n, [], None
        while i and x != y:
            px, py = self.up[x][0], self.up[y][0]
            if self.length[x] == self.length[y] == i and (x, y) in self.same:
                known = self.same[x, y]
                differ = differ if known == i else known
                break
            if self.length[x] == self.length[y] == i:
                seen.append((x, y))
            start = max(self.length[px], self.length[py])
            left, right = self.piece[x][start - self.length[px] : i - self.length[px]], self.piece[y][start - self.length[py] : i - self.length[py]]
            if left != right:
                differ = start + next(k for k, (c, d) in enumerate(zip(left, right, strict=True)) if c != d)
            i = start
            if self.length[px] == start:
                x = px
            if self.length[py] == start:
                y = py
        true = n if differ is None else differ
        for p, q in seen:  # pairs of nodes of equal length that were walked: how much of them is equal
            self.same[p, q] = min(true, self.length[p])
        return true

    def less(self, a: int, tail_a: str, b: int, tail_b: str) -> bool:
        """Whether string a with its tail sorts before string b with its tail."""
        if a == b:
            return tail_a < tail_b
        n = self.common(a, b)
        la, lb = self.length[a], self.length[b]
        if n < la and n < lb:
            return self.char(a, n) < self.char(b, n)
        # One is a prefix of the other: what is left of the longer one against the tail.
        left = (self._from(a, n) + tail_a) if la - n <= lb - n else tail_a
        right = (self._from(b, n) + tail_b) if lb - n <= la - n else tail_b
        if la > n:
            left = self._from(a, n, len(right)) + tail_a
        if lb > n:
            right = self._from(b, n, len(left)) + tail_b
        return left < right

    def _from(self, node: int, n: int, most: int | None = None) -> str:
        """Characters n, n + 1, ... of a string, at least ``most`` of them if it has so many."""
        end = self.length[node] if most is None else min(self.length[node], n + most + 1)
        out, h = [], self.holder(node, end) if end > n else 0
        while h and self.length[h] > n:
            parent = self.up[h][0]
            out.append(self.piece[h][max(0, n - self.length[parent]) : end - self.length[parent]])
            h = parent
        return "".join(reversed(out))


Best = dict[int, tuple[int, int]]  # state -> cost, node


def _offer(trails: Trails, offers: dict, state: int, cost: int, node: int, piece: str) -> None:
    old = offers.get(state)
    if old is None or cost < old[0] or (cost == old[0] and trails.less(node, piece, old[1], old[2])):
        offers[state] = (cost, node, piece)


def _inserted(trails: Trails, best: Best) -> Best:
    """The states with insertions added wherever they are cheaper (or as cheap, and earlier in the order)."""
    again = True
    while again:
        again = False
        for state, role in ((0, "u"), (1, "u"), (3, "u"), (2, "a")):
            if state not in best:
                continue
            cost, node = best[state]
            to = _STEP[role][state]
            old = best.get(to)
            if old is None or cost + INSERT < old[0] or (cost + INSERT == old[0] and trails.less(node, "I", old[1], "")):
                best[to] = (cost + INSERT, trails.add(node, "I"))
                again = True
    return best


def solve(rows: Iterable[tuple[str, bool, bool]], start: int, trails: Trails | None = None) -> tuple[Trails, Best]:
    """Cheapest edits from state ``start`` to each state over rows of (role initial, must be deleted, truncated)."""
    trails = trails or Trails()
    best = _inserted(trails, {start: (0, 0)})
    for initial, must, truncated in rows:
        offers: dict = {}
        stay = TRUNCATED if truncated else 0
        for state, (cost, node) in best.items():
            _offer(trails, offers, state, cost + DELETE, node, "D")
            if must:
                continue
            to = _STEP.get(initial, {}).get(state)
            if to is not None:
                _offer(trails, offers, to, cost + stay, node, "K")
            _offer(trails, offers, 3 if state == 2 else 2, cost + REROLE + stay, node, "R")
        best = _inserted(trails, {s: (c, trails.add(n, p)) for s, (c, n, p) in offers.items()})
    return trails, best


def finish(trails: Trails, best: Best) -> tuple[int, int, int]:
    """(cost, state, node) of the cheapest accepting end; of equal costs the audit that sorts first."""
    ends = [(best[s][0], s, best[s][1]) for s in ENDS if s in best]
    out = ends[0]
    for e in ends[1:]:
        if e[0] < out[0] or (e[0] == out[0] and trails.less(e[2], "", out[2], "")):
            out = e
    return out


def edits(audit: str, initials: Iterable[str], state: int) -> Iterator[tuple[str, str | None, str]]:
    """For each row what the audit does: lines inserted before it, its new role (None: deleted, "": kept), lines inserted after the last row."""
    at, rows = 0, list(initials)

    def insert() -> str:
        nonlocal at, state
        out = []
        while at < len(audit) and audit[at] == "I":
            state = 3 if state == 2 else 2
            out.append(f"{_ROLE[state]}:")
            at += 1
        return "\n".join(out)

    for k, initial in enumerate(rows):
        before = insert()
        op, at = audit[at], at + 1
        role: str | None = None
        if op == "K":
            state, role = _STEP[initial][state], ""
        elif op == "R":
            state = 3 if state == 2 else 2
            role = _ROLE[state]
        yield before, role, insert() if k == len(rows) - 1 else ""


def repaired_lines(role: str, text: str, edit: tuple[str, str | None, str]) -> Iterator[str]:
    before, new, after = edit
    if before:
        yield before
    if new is not None:
        yield f"{new or role}:{text}"
    if after:
        yield after


# --- damage ---------------------------------------------------------------------------


def _null_as_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """The fault that crc32("conv_id:turn") % 20 names: 0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes it a user row.

    Null roles and texts become one space first; a null conv_id or turn is one space in the key and stays null in the row.
    """
    key = F.concat(_null_as_space(F.col("conv_id")), F.lit(":"), _null_as_space(F.col("turn")))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    rows = turns.select("conv_id", "turn", _null_as_space(F.col("role")).alias("role"), _null_as_space(F.col("text")).alias("text"), kind.alias("k")).where("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "k")
    return rows.select("*", F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_")).drop("k", "_")


# --- operator -------------------------------------------------------------------------

_KEYS = ["conv_id", "turn", "role", "lead", "digest"]
_RESULT = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows with their sort keys and faults (blank, truncated): ties of a turn go by role, then by text (its first 64 characters, then its digest)."""
    text = F.rtrim(F.translate("text", SPACES[1:], " " * (len(SPACES) - 1)))
    return turns.select(
        "conv_id", "turn", "role", "text",
        F.substring("text", 1, 64).alias("lead"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"),
        (text == "").alias("blank"),
        (~F.substring(text, -1, 1).isin(".", "!", "?")).alias("open"),
    )


def _illegal(before: str | None, now: str) -> bool:
    return before is not None and before + now not in ("su", "ua", "au")


def _small(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations of up to a block of rows, one at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for t in groups(batches, ["conv_id"]):
            roles, texts, blanks, opens = (t.column(c).to_pylist() for c in ("role", "text", "blank", "open"))
            seen: set[tuple[str, str]] = set()
            counts, steps, last = [0, 0, 0, 0], [], None
            for role, text, blank, is_open in zip(roles, texts, blanks, opens, strict=True):
                copy = not blank and (role, text) in seen
                seen.add((role, text))
                cut = is_open and not blank and not copy
                for i, fault in enumerate((blank, copy, cut, _illegal(last, role[:1]))):
                    counts[i] += fault
                last = role[:1]
                steps.append((last, blank or copy, cut))
            trails, best = solve(steps, 0)
            cost, _, node = finish(trails, best)
            audit = trails.text(node)
            lines = [x for r, s, e in zip(roles, texts, edits(audit, [s[0] for s in steps], 0), strict=True) for x in repaired_lines(r, s, e)]
            digest = hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()
            out.append((t.column("conv_id")[0].as_py(), *counts, cost, audit, digest))
            if len(out) >= 1024:
                yield _batch(out)
                out = []
        yield _batch(out)

    arrow = _arrow_type(rows, "conv_id")

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [()] * 8
        types = [arrow, *[pa.int64()] * 5, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["conv_id", *_COUNTS, "audit", "repaired_sha256"])

    # Spread by a hash that keeps null apart, so that a task has whole conversations in order.
    dealt = rows.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in _KEYS])
    return map_arrow(dealt, run, f"conv_id {kind}, {_RESULT}")


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _large(rows: DataFrame, kind: str, block: int) -> DataFrame:
    """Conversations of any length: blocks solved alone, joined in order, and applied row by row."""
    arrow = _arrow_type(rows, "conv_id")
    # Range partitions cut a long conversation anywhere; the last key splits equal rows too.
    rows = rows.withColumn("salt", F.monotonically_increasing_id())
    keys = [F.asc_nulls_first(c) for c in (*_KEYS, "salt")]
    placed = checkpoint(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("lead", "salt").withColumn("rid", F.monotonically_increasing_id()))
    first = per_key(placed, ["conv_id", "role", "digest"], F.min("rid").alias("first")).toDF("f_conv", "f_role", "f_digest", "first")
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    flags = placed.join(first, same).select(
        "conv_id", "rid", F.expr(f"rid div {int(block)}").alias("seg"), F.substring("role", 1, 1).alias("initial"), "blank",
        (~F.col("blank") & (F.col("rid") > F.col("first"))).alias("copy"), "open",
    )
    # A block is one task's part of one conversation: rid holds the partition in its upper bits.
    narrow = checkpoint(flags.repartition("conv_id", "seg").sortWithinPartitions(F.asc_nulls_first("conv_id"), "seg", "rid"))

    def solve_block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["conv_id", "seg"]):
            initials, blanks, copies, opens = (t.column(c).to_pylist() for c in ("initial", "blank", "copy", "open"))
            steps = [(i, b or c, o and not b and not c) for i, b, c, o in zip(initials, blanks, copies, opens, strict=True)]
            illegal = sum(_illegal(a, b) for a, b in zip(initials, initials[1:], strict=False))
            paths = []
            for start in STATES:
                trails, best = solve(steps, start)
                paths += [{"start": start, "end": s, "cost": c, "audit": trails.text(n)} for s, (c, n) in best.items()]
            yield pa.RecordBatch.from_pylist(
                [{
                    "conv_id": t.column("conv_id")[0].as_py(), "seg": t.column("seg")[0].as_py(), "initials": initials, "blank": sum(blanks),
                    "duplicate": sum(copies), "truncated": sum(s[2] for s in steps), "illegal": illegal, "paths": paths,
                }],
                pa.schema([
                    ("conv_id", arrow), ("seg", pa.int64()), ("initials", pa.list_(pa.string())), *[(c, pa.int64()) for c in _COUNTS[:4]],
                    ("paths", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
                ]),
            )

    counts = "blank long, duplicate long, truncated long, illegal long"
    blocks = checkpoint(map_arrow(narrow, solve_block, f"conv_id {kind}, seg long, initials array<string>, {counts}, paths array<struct<start:int,end:int,cost:long,audit:string>>"))

    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of (conv_id, seg, start, audit) for each block, and one with seg null for the conversation."""
        schema = pa.schema([("conv_id", arrow), ("seg", pa.int64()), ("start", pa.int32()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string())])
        held, state = None, None

        def close() -> Iterator[pa.RecordBatch]:
            conv, trails, best, segs, totals, _ = state
            cost, end, at = finish(trails, {s: (c, n) for s, (c, n, _) in best.items()})
            chain, pieces, starts, out = best[end][2], [], [], []
            while at:
                pieces.append(trails.piece[at])
                at = trails.up[at][0]
            while chain is not None:
                starts.append(chain[0])
                chain = chain[1]
            for seg, start, piece in zip(segs, reversed(starts), reversed(pieces), strict=True):
                out.append({"conv_id": conv, "seg": seg, "start": start, "audit": piece})
            out.append({"conv_id": conv, **totals, "cost": cost, "audit": "".join(reversed(pieces))})
            for i in range(0, len(out), 256):
                yield pa.RecordBatch.from_pylist(out[i : i + 256], schema)

        for t in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            r = t.to_pylist()[0]
            if state is None or r["conv_id"] != held:
                if state is not None:
                    yield from close()
                held, state = r["conv_id"], (r["conv_id"], Trails(), {0: (0, 0, None)}, [], dict.fromkeys(_COUNTS[:4], 0), [None])
            _, trails, best, segs, totals, last = state
            offers: dict = {}
            came: dict[int, int] = {}
            for p in r["paths"]:
                if p["start"] not in best:
                    continue
                cost, node, _ = best[p["start"]]
                _offer(trails, offers, p["end"], cost + p["cost"], node, p["audit"])
                if offers[p["end"]] == (cost + p["cost"], node, p["audit"]):
                    came[p["end"]] = p["start"]
            state = (held, trails, {s: (c, trails.add(n, x), (came[s], best[came[s]][2])) for s, (c, n, x) in offers.items()}, segs, totals, last)
            segs.append(r["seg"])
            for c in _COUNTS[:4]:
                totals[c] += r[c]
            totals["illegal"] += _illegal(last[0], r["initials"][0])
            last[0] = r["initials"][-1]
        if state is not None:
            yield from close()

    by_conv = blocks.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "seg")
    joined = checkpoint(map_arrow(by_conv, compose, f"conv_id {kind}, seg long, start int, {counts}, cost long, audit string"))
    ways = joined.where("seg IS NOT NULL").select("seg", F.col("conv_id").alias("conv"), "start", F.col("audit").alias("way"))
    plans = blocks.select("conv_id", "seg", "initials").join(ways, (blocks.seg == ways.seg) & blocks.conv_id.eqNullSafe(ways.conv)).drop(ways.seg)

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                made = list(edits(r["way"], r["initials"], r["start"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["conv_id"]] * len(made), arrow), pa.array([r["seg"]] * len(made), pa.int64()), pa.array(range(len(made)), pa.int64()), *[pa.array(c, pa.string()) for c in zip(*made, strict=True)]],
                    ["conv_id", "seg", "k", "before", "new", "after"],
                )

    done = map_arrow(plans.select("conv_id", "seg", "initials", "start", "way"), spread, f"conv_id {kind}, seg long, k long, before string, new string, after string")
    # The k-th row of a block has the k-th smallest rid; blocks are one partition's stretch of one conversation, so rids follow each other.
    starts = narrow.groupBy("conv_id", "seg").agg(F.min("rid").alias("low"))
    done = done.join(starts, done.conv_id.eqNullSafe(starts.conv_id) & (done.seg == starts.seg)).select((F.col("low") + F.col("k")).alias("row"), "before", "new", "after")
    line = F.when(F.col("new").isNotNull(), F.concat(F.when(F.col("new") == "", F.col("role")).otherwise(F.col("new")), F.lit(":"), F.col("text")))
    none = F.lit(None).cast("string")
    lines = F.concat_ws("\n", F.when(F.col("before") != "", F.col("before")).otherwise(none), line, F.when(F.col("after") != "", F.col("after")).otherwise(none))
    has = (F.col("before") != "") | F.col("new").isNotNull() | (F.col("after") != "")
    texts = placed.join(done, placed.rid == done.row).where(has).select("conv_id", "rid", lines.alias("lines"))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """SHA-256 of a conversation's lines, streamed: one digest is one sequence of bytes."""
        held, sha = None, None
        make = lambda: pa.RecordBatch.from_arrays([pa.array([held], arrow), pa.array([sha.hexdigest()])], ["conv_id", "sha"])
        for batch in batches:
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if sha is None or conv != held:
                    if sha is not None:
                        yield make()
                    held, sha = conv, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(text.encode("utf-8", "surrogatepass"))
        if sha is not None:
            yield make()

    shas = map_arrow(texts.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "rid"), digest, f"conv_id {kind}, sha string")
    shas = shas.select(F.col("conv_id").alias("conv"), "sha")
    whole = joined.where("seg IS NULL")
    return whole.join(shas, whole.conv_id.eqNullSafe(shas.conv), "left").select(
        "conv_id", *_COUNTS, "audit", F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")
    )


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults, the cheapest repair and its audit.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.  ``audit`` has a letter per edit in order (Keep, Rerole,
    Delete, Insert); of equally cheap repairs the one whose audit sorts first.

    Rows go by turn, nulls first; rows of one turn by role, then text (its
    first 64 characters, then its SHA-256).  A null conv_id is a conversation of its own.  Roles and
    texts must not be null (``damage`` replaces them).  Repeated rows are
    duplicates; an empty table gives no rows; extra columns are ignored.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = _ordered(turns)
    count = F.max("turn").cast("long") - F.min("turn").cast("long") + 1 - F.countDistinct("turn")
    sizes = checkpoint(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(count, F.lit(0)).cast("long").alias("gaps")))
    large = sizes.where(F.col("rows") > block).select(F.col("conv_id").alias("conv"))
    found = _small(rows.join(large, rows.conv_id.eqNullSafe(large.conv), "left_anti"), kind)
    if not large.isEmpty():
        found = found.unionByName(_large(rows.join(large, rows.conv_id.eqNullSafe(large.conv), "left_semi"), kind, block))
    gaps = sizes.select(F.col("conv_id").alias("conv"), "gaps")
    return found.join(gaps, found.conv_id.eqNullSafe(gaps.conv)).select("conv_id", "gaps", *_COUNTS, "audit", "repaired_sha256")


def with_empty(found: DataFrame, turns: DataFrame) -> DataFrame:
    """``found`` with a row of zeros, an empty audit and the digest of nothing for each conversation of ``turns`` that it lacks."""
    every = turns.select(F.col("conv_id").alias("conv")).distinct()
    zero = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", *_COUNTS)}
    return every.join(found, every.conv.eqNullSafe(found.conv_id), "left").select(
        F.col("conv").alias("conv_id"), *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
