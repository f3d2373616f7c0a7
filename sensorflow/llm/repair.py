"""Conversations whose turns don't alternate, are blank, repeated or cut off: faults, cheapest repair, repaired texts.

Rows are range-sorted by (conversation, turn, role, beginning and hash of the text), so a conversation of any length is spread
over tasks; equal rows are told apart by a salt, since their order doesn't matter. In its task each conversation that lies there
as a whole is judged at once (``turns``). Of the few that do not - the first and the last of each task, and those longer than a
span of SPAN_ROWS rows or SPAN_BYTES bytes - the spans are written to a table and meet as small rows:

1. words of each span's (conversation, role, text) hashes that an earlier span holds: one count of hashes;
2. each span's table of costs from every state before it to every state behind it (16 numbers);
3. a walk from the last span to the first gives the cost to the end behind each span, and with it each span's least path from
   each state;
4. a walk from the first span to the last gives the state each is entered in, so that it can write its audit and texts;
5. a last walk joins these and hashes the texts.

A walk reads the sorted rows of a task one after the other and holds one conversation's state, never its rows.

Null roles and texts count as one space; a role whose initial isn't s, u or a has to be changed or deleted. Rows of one turn are
ordered by role, then by the first 64 characters and a hash of the text; a null turn comes first and has no part in the gaps.
Rows without a conversation form one of their own. Equal rows are duplicates of one another. A conversation whose rows are all
absent (column ``present``) or an empty table gives no faults and an empty audit, or no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm import turns
from sensorflow.llm.frames import BLANKS, in_arrow, read, slices, stored

SPAN_ROWS = 4096
SPAN_BYTES = 1 << 22
SALTS = 1024
ENDS = ".!?"

#: Of each span: rows, blank, duplicate, truncated and illegal ones, least and greatest turn, distinct turns, initials at both ends.
STATS = ("rows", "blank", "duplicate", "truncated", "illegal", "low", "high", "distinct", "head", "tail")
NO_TURN = (np.iinfo(np.int64).max, np.iinfo(np.int64).min)
RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
SPAN = "conv_id bigint, place bigint, turn array<bigint>, role array<string>, text array<string>, fault array<tinyint>, initial array<tinyint>, h1 array<bigint>, h2 array<bigint>"
FORMED = f"conv_id bigint, place bigint, edge boolean, {RESULT}, {SPAN.split(', ', 2)[2]}"
LEGAL = np.zeros(16, bool)
LEGAL[[1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2]] = True  # su, ua, au
BLANK, DUPLICATE, CUT = 1, 2, 3


def marked(rows: DataFrame) -> DataFrame:
    """What a task needs of each row: keys, texts, its own fault (0, BLANK or CUT), code of the initial, hashes, and the sort keys."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    plain = rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), role.alias("role"), text.alias("text"), present.alias("present"))
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", BLANK).when(~last.isin(*ENDS), CUT).otherwise(0)
    initial = F.lit(0)
    for letter, code in turns.INITIALS.items():
        initial = F.when(F.left("role", F.lit(1)) == letter, code).otherwise(initial)

    def hashed(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "conv_id", "role", "text")

    return plain.select(
        "*", fault.cast("tinyint").alias("fault"), initial.cast("tinyint").alias("initial"), hashed(1).alias("h1"), hashed(2).alias("h2"),
        F.left("text", F.lit(64)).alias("begin"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt"),
    )


def formed(rows: DataFrame, span_rows: int = SPAN_ROWS) -> DataFrame:
    """Whole conversations with their results, and spans (``edge``) of the others; written to a table."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "begin", "h1", "salt"]
    dealt = marked(rows).repartitionByRange(*order).sortWithinPartitions(*order).drop("begin", "salt")
    return stored(in_arrow(dealt, partial(_form, span_rows=span_rows), FORMED), "conversations")


def _breaks(conversations: pa.Array) -> np.ndarray:
    """Where another conversation begins, the first row included; nulls are equal."""
    number = pc.fill_null(conversations, 0).to_numpy(zero_copy_only=False)
    missing = conversations.is_null().to_numpy(zero_copy_only=False)
    change = (number[1:] != number[:-1]) | (missing[1:] != missing[:-1])
    return np.flatnonzero(np.concatenate([[len(number) > 0], change]))


def _form(batches: Iterator[pa.RecordBatch], span_rows: int) -> Iterator[pa.RecordBatch]:
    place = TaskContext.get().partitionId() << 32
    held: pa.RecordBatch | None = None
    first = True  # the held conversation is the task's first one, or a part of it has gone
    for batch in slices(batches, "text", SPAN_BYTES):
        if held is not None:
            batch = pa.concat_batches([held, batch])
        begins = _breaks(batch.column("conv_id"))
        if len(begins) > 1:
            if first:
                yield _spans(batch.slice(0, begins[1]), place)
                place += 1
            inner = batch.slice(begins[1] if first else 0, begins[-1] - (begins[1] if first else 0))
            if inner.num_rows:
                yield _whole(inner)
            first = False
        held = batch.slice(begins[-1])
        if held.num_rows >= span_rows or held.column("text").nbytes >= SPAN_BYTES:
            yield _spans(held, place)
            place += 1
            # a row without any text keeps the conversation's key, so that what follows is seen as its next span
            held = _absent(held)
            first = True
    if held is not None:
        yield _spans(held, place)


def _absent(batch: pa.RecordBatch) -> pa.RecordBatch:
    one = batch.slice(0, 1)
    return one.set_column(one.schema.get_field_index("present"), "present", pa.array([False]))


def _spans(batch: pa.RecordBatch, place: int) -> pa.RecordBatch:
    """One span: its rows as arrays, no result yet."""
    there = batch.filter(batch.column("present"))
    names = [c.split(" ")[0] for c in SPAN.split(", ")[2:]]
    ends = pa.array([0, there.num_rows], pa.int32())
    columns = {"conv_id": batch.column("conv_id").slice(0, 1), "place": pa.array([place], pa.int64()), "edge": pa.array([True])}
    columns |= {c.split(" ")[0]: pa.nulls(1, pa.string() if "string" in c else pa.int64()) for c in RESULT.split(", ")}
    columns |= {name: pa.ListArray.from_arrays(ends, there.column(name)) for name in names}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _whole(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Results of conversations that lie in the batch as a whole."""
    begins = _breaks(batch.column("conv_id"))
    here = batch.column("present").to_numpy(zero_copy_only=False)
    first = np.concatenate([[0], np.cumsum(here)])[np.append(begins, len(here))]
    there = batch.filter(batch.column("present"))
    spans, stats = judged(there, first, [()] * len(begins))
    known = turns.costs(spans, np.broadcast_to(turns.END, (len(begins), 4)))
    letters, target = turns.arcs(spans, known, np.ones(len(begins), bool))
    rank, pointers = turns.ranked(letters, target)
    starts = spans.at * 4 + turns.START
    lines = turns.audits(starts, letters, rank, pointers)
    roles, texts = there.column("role").to_pylist(), there.column("text").to_pylist()
    shas = []
    for audit, a, b in zip(lines, first[:-1].tolist(), first[1:].tolist(), strict=True):
        text = "\n".join(turns.repaired(audit, turns.START, roles[a:b], texts[a:b]))
        shas.append(hashlib.sha256(text.encode()).hexdigest())
    columns = {"conv_id": batch.column("conv_id").take(pa.array(begins)), "place": pa.nulls(len(begins), pa.int64()), "edge": pa.array(np.zeros(len(begins), bool))}
    columns |= {"gaps": pa.array(_gaps(stats))} | {name: pa.array(stats[name]) for name in STATS[1:5]}
    columns |= {"cost": pa.array(known.ravel()[starts]), "audit": pa.array([x.decode() for x in lines]), "repaired_sha256": pa.array(shas)}
    for column in SPAN.split(", ")[2:]:
        kind = {"array<bigint>": pa.int64(), "array<string>": pa.string(), "array<tinyint>": pa.int8()}[column.split(" ")[1]]
        columns[column.split(" ")[0]] = pa.nulls(len(begins), pa.list_(kind))
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _gaps(stats: dict[str, np.ndarray]) -> np.ndarray:
    known = stats["distinct"] > 0
    return np.where(known, np.where(known, stats["high"], 0) - np.where(known, stats["low"], 0) + 1 - stats["distinct"], 0)


def judged(rows: pa.RecordBatch, first: np.ndarray, seen: list) -> tuple[turns.Spans, dict[str, np.ndarray]]:
    """Faults of the rows of several runs, each a conversation or a span; ``seen[k]`` are hashes that run k's conversation had before."""
    fault = rows.column("fault").to_numpy().copy()
    initial = rows.column("initial").to_numpy().astype(np.int64)
    sizes = np.diff(first)
    run = np.repeat(np.arange(len(sizes)), sizes)
    keys = list(zip(rows.column("h1").to_pylist(), rows.column("h2").to_pylist(), strict=True))
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        had = set(seen[k])
        for at in range(a, b):
            if keys[at] in had:
                fault[at] = fault[at] if fault[at] == BLANK else DUPLICATE
            else:
                had.add(keys[at])
    stats = {name: np.bincount(run[fault == kind], minlength=len(sizes)) for name, kind in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))}
    stats["rows"] = sizes
    beside = run[1:] == run[:-1] if len(run) else np.zeros(0, bool)
    illegal = beside & ~LEGAL[initial[:-1] * 4 + initial[1:]]
    stats["illegal"] = np.bincount(run[1:][illegal], minlength=len(sizes))
    turn = rows.column("turn")
    timed = turn.is_valid().to_numpy(zero_copy_only=False)
    number = pc.fill_null(turn, 0).to_numpy(zero_copy_only=False)
    low, high = (np.full(len(sizes), x) for x in NO_TURN)
    np.minimum.at(low, run[timed], number[timed])
    np.maximum.at(high, run[timed], number[timed])
    # rows are sorted by turn with nulls first, so a turn that differs from the row before it is a new one
    new = timed.copy()
    new[1:] &= ~(beside & timed[:-1] & (number[1:] == number[:-1]))
    stats |= {"low": low, "high": high, "distinct": np.bincount(run[new], minlength=len(sizes))}
    stats["head"], stats["tail"] = np.full(len(sizes), -1), np.full(len(sizes), -1)
    some = sizes > 0
    stats["head"][some], stats["tail"][some] = initial[first[:-1][some]], initial[first[1:][some] - 1]
    return turns.Spans(first, initial, (fault == BLANK) | (fault == DUPLICATE), fault == CUT), stats


def _runs(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of all spans of a batch, and where each span begins."""
    names = [c.split(" ")[0] for c in SPAN.split(", ")[2:] if c.split(" ")[0] in batch.schema.names]
    sizes = pc.fill_null(pc.list_value_length(batch.column("fault")), 0).to_numpy(zero_copy_only=False)
    rows = pa.RecordBatch.from_arrays([batch.column(n).flatten() for n in names], names=names)
    return rows, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _seen(batch: pa.RecordBatch) -> list:
    return [[(x["h1"], x["h2"]) for x in had or ()] for had in batch.column("seen").to_pylist()]


def _small(batches: Iterator[pa.RecordBatch], spans: int = 16) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, spans):
            yield batch.slice(begin, spans)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _small(batches):
        spans, stats = judged(*_runs(batch), _seen(batch))
        through = turns.transfers(spans).reshape(batch.num_rows, 16)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("place"), pa.array(through.tolist()), pa.array(np.stack([stats[n] for n in STATS], axis=1).tolist())],
            ["conv_id", "place", "through", "stats"],
        )


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost to the end behind each span; the spans come from the last of a conversation to the first."""
    before, end = None, turns.END
    for batch in batches:
        out = []
        for conv, place, through in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "through")), strict=True):
            last = before is None or before[0] != conv
            if last:
                before, end = (conv,), turns.END
            out.append({"place": place, "last": last, "end": end.tolist()})
            end = (np.array(through).reshape(4, 4) + end).min(axis=1)
        yield pa.RecordBatch.from_pylist(out, pa.schema([("place", pa.int64()), ("last", pa.bool_()), ("end", pa.list_(pa.int64()))]))


def _solved(batch: pa.RecordBatch) -> tuple:
    rows, first = _runs(batch)
    spans, _ = judged(rows, first, _seen(batch))
    known = turns.costs(spans, np.array(batch.column("end").to_pylist(), np.int64).reshape(-1, 4))
    letters, target = turns.arcs(spans, known, batch.column("last").to_numpy(zero_copy_only=False))
    return spans, known, letters, *turns.ranked(letters, target), rows, first


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State behind each span by the state before it, on least paths; and the cost from the start, for a conversation's first span."""
    for batch in _small(batches):
        spans, known, _, _, pointers, *_ = _solved(batch)
        out = pointers[-1][spans.at[:, None] * 4 + np.arange(4)] % 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), pa.array(out.tolist(), pa.list_(pa.int64())), pa.array(known[spans.at, turns.START])], ["place", "exits", "cost"]
        )


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State each span is entered in, and behind a conversation's last span its counts."""
    kept: dict | None = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if kept is None or kept["conv"] != row["conv_id"]:
                kept = {"conv": row["conv_id"], "state": turns.START, "cost": row["cost"], "stats": None}
            out.append({"place": row["place"], "entry": kept["state"], "cost": kept["cost"]})
            kept["state"] = row["exits"][kept["state"]]
            kept["stats"] = _together(kept["stats"], dict(zip(STATS, row["stats"], strict=True)))
            if row["last"]:
                total = kept["stats"]
                gaps = total["high"] - total["low"] + 1 - total["distinct"] if total["distinct"] else 0
                out[-1] |= {"gaps": gaps} | {name: total[name] for name in STATS[1:5]}
        fields = [("place", pa.int64()), ("entry", pa.int64()), ("cost", pa.int64())]
        yield pa.RecordBatch.from_pylist(out, pa.schema(fields + [(n, pa.int64()) for n in ("gaps", *STATS[1:5])]))


def _together(one: dict | None, two: dict) -> dict:
    """Counts of two neighbouring spans as those of one."""
    if one is None or not one["rows"]:
        return two
    if not two["rows"]:
        return one
    out = {name: one[name] + two[name] for name in (*STATS[:5], "distinct")}
    out["illegal"] += int(not LEGAL[one["tail"] * 4 + two["head"]])
    out["distinct"] -= int(one["distinct"] > 0 and two["distinct"] > 0 and one["high"] == two["low"])
    return out | {"low": min(one["low"], two["low"]), "high": max(one["high"], two["high"]), "head": one["head"], "tail": two["tail"]}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _small(batches):
        spans, _, letters, rank, pointers, rows, first = _solved(batch)
        entry = batch.column("entry").to_numpy()
        lines = turns.audits(spans.at * 4 + entry, letters, rank, pointers)
        roles, texts = rows.column("role").to_pylist(), rows.column("text").to_pylist()
        kept = [
            turns.repaired(line, state, roles[a:b], texts[a:b])
            for line, state, a, b in zip(lines, entry.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True)
        ]
        columns = [batch.column("conv_id"), batch.column("place"), pa.array([x.decode() for x in lines]), pa.array([len(x) for x in kept], pa.int64()), pa.array(["\n".join(x) for x in kept])]
        columns += [batch.column(c) for c in ("gaps", *STATS[1:5], "cost")]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "audit", "lines", "texts", "gaps", *STATS[1:5], "cost"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits and hashes from the pieces of each conversation in their order; a row with ``gaps`` is its last."""
    audit, sha, lines = [], hashlib.sha256(), 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            audit.append(row["audit"])
            if row["lines"]:
                sha.update(("\n" * (lines > 0) + row["texts"]).encode())
                lines += row["lines"]
            if row["gaps"] is not None:
                out.append({n: row[n] for n in ("conv_id", "gaps", *STATS[1:5], "cost")} | {"audit": "".join(audit), "repaired_sha256": sha.hexdigest()})
                audit, sha, lines = [], hashlib.sha256(), 0
        fields = [(n, pa.int64()) for n in ("conv_id", "gaps", *STATS[1:5], "cost")]
        yield pa.RecordBatch.from_pylist(out, pa.schema([*fields, ("audit", pa.string()), ("repaired_sha256", pa.string())]))


def _walk(rows: DataFrame, step: Callable, schema: str, last_first: bool = False) -> DataFrame:
    """The spans of each conversation one after the other; all walks of a conversation are in one task, as a stream."""
    order = F.desc("place") if last_first else F.asc("place")
    return in_arrow(rows.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), order), step, schema)


def spanned(spans: DataFrame) -> DataFrame:
    """Results of the conversations that lie in several spans, or at the border of a task."""
    keys = spans.select("place", F.explode(F.array_distinct(F.arrays_zip("h1", "h2"))).alias("hash")).select("place", "hash.h1", "hash.h2")
    first = keys.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    seen = keys.join(first, ["h1", "h2"]).where("place > first").groupBy("place").agg(F.collect_list(F.struct("h1", "h2")).alias("seen"))
    small = [c.split(" ")[0] for c in SPAN.split(", ") if not c.startswith(("role", "text"))]
    numbers = "conv_id bigint, place bigint"
    lean = stored(spans.select(*small).join(seen, "place", "left").select(*small, "seen"), "conversation-spans")
    sums = stored(in_arrow(lean, _summaries, f"{numbers}, through array<bigint>, stats array<bigint>"), "conversation-sums")
    ends = stored(_walk(sums.drop("stats"), _backwards, "place bigint, last boolean, end array<bigint>", True), "conversation-ends")
    exits = in_arrow(lean.join(ends, "place"), _exits, "place bigint, exits array<bigint>, cost bigint")
    walked = sums.select("conv_id", "place", "stats").join(exits, "place").join(ends.select("place", "last"), "place")
    counts = ", ".join(f"{n} bigint" for n in ("gaps", *STATS[1:5]))
    entries = stored(_walk(walked, _forwards, f"place bigint, entry bigint, cost bigint, {counts}"), "conversation-entries")
    whole = spans.join(lean.select("place", "seen"), "place").join(ends, "place").join(entries, "place")
    pieces = in_arrow(whole, _pieces, f"{numbers}, audit string, lines bigint, texts string, {counts}, cost bigint")
    return _walk(pieces, _joined, f"conv_id bigint, {counts}, cost bigint, audit string, repaired_sha256 string")


def repair(rows: DataFrame, span_rows: int = SPAN_ROWS) -> DataFrame:
    """(conv_id, turn, role, text) -> one row per conversation; a row with ``present`` false only names its conversation."""
    every = formed(rows, span_rows)
    names = ["conv_id", *[c.split(" ")[0] for c in RESULT.split(", ")]]
    spans = every.where("edge").select(*[c.split(" ")[0] for c in SPAN.split(", ")])
    return every.where("not edge").select(*names).unionByName(spanned(spans).select(*names))


def damaged(rows: DataFrame) -> DataFrame:
    """The fixed damage of the named query: by a checksum of (conversation, turn) rows are absent, emptied, cut off, repeated or renamed."""
    plain = rows.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
        F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]).alias("name"),
    )
    fate = F.crc32("name") % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    role = F.when(fate == 4, "user").otherwise(F.col("role"))
    return plain.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fate != 0).alias("present"), F.explode(copies)).drop("col")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(read(spark, sf_dir, "conversations")))
