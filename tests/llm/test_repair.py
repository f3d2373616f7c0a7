"""Conversation repair against a search over all edits, whole and in spans, and the ranks against sorted audits."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorflow.llm import repair, turns

BLANKS = " \t\n\x0b\f\r"


def faults(rows):
    """First fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(BLANKS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows):
    """Least (cost, audit, turns) by trying every edit, and up to two inserts, before and behind each row."""
    found = faults(rows)

    def legal(initials):
        return re.fullmatch(r"(s?(ua)*u?)?", initials) is not None

    def state(initials):
        return initials[-1:] if initials else ""

    paths = {"": (0, "", "", ())}  # state -> cost, audit, initials, turns

    def better(new, old):
        return old is None or new[:2] < old[:2]

    def add(table, item):
        if legal(item[2]) and better(item, table.get(state(item[2]))):
            table[state(item[2])] = item

    def inserted(table):
        for _ in range(2):
            for cost, audit, initials, out in list(table.values()):
                for role in ("user", "assistant"):
                    add(table, (cost + 2, audit + "I", initials + role[0], (*out, f"{role}:")))
        return table

    for (role, text), fault in zip(rows, found, strict=True):
        after = {}
        for cost, audit, initials, out in inserted(paths).values():
            add(after, (cost + 3, audit + "D", initials, out))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if role[:1]:
                add(after, (cost + extra, audit + "K", initials + role[0], (*out, f"{role}:{text}")))
            for new in ("user", "assistant"):
                add(after, (cost + 2 + extra, audit + "R", initials + new[0], (*out, f"{new}:{text}")))
        paths = after
    ends = [p for p in inserted(paths).values() if re.fullmatch(r"(s?(ua)+)?", p[2])]
    return min(ends, key=lambda p: p[:2])


def wanted(rows):
    """(turn, role, text) in any order -> the operator's row."""
    rows = sorted(((t, r or (" " if r is None else ""), " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    plain = [(r, x) for _, r, x in rows]
    found = faults(plain)
    known = [t for t, _, _ in rows if t is not None]
    cost, audit, _, out = search(plain)
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        **{kind: found.count(kind) for kind in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(plain, plain[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def conversation(rng, size):
    roles = ["user", "assistant", "system", "tool", "user", "assistant", ""]
    texts = ["Yes.", "No!", "and so", " ", "", "What?", "x", None]
    good = [(t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(1, size + 1)]
    return [row if rng.random() < 0.6 else (rng.choice([row[0], row[0], row[0] + 1, None]), rng.choice(roles), rng.choice(texts)) for row in good]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=9), st.integers(0, 8))
def test_least_audits(rows, cut):
    """Alone, and as two spans that know each other only by their tables of costs."""
    plain = [({"s": "system", "u": "user", "a": "assistant", "x": "tool"}[r], "" if gone else f"{k}" + "." * (not short)) for k, (r, gone, short) in enumerate(rows)]
    found = faults(plain)
    code = np.array([turns.INITIALS.get(r, 0) for r, _, _ in rows], np.int64)
    gone, short = np.array([f in ("blank", "duplicate") for f in found], bool), np.array([f == "truncated" for f in found], bool)
    cost, audit, _, out = search(plain)

    def spans(a, b):
        return turns.Spans(np.array([0, b - a]), code[a:b], gone[a:b], short[a:b])

    def solved(part, end, last):
        known = turns.costs(part, end[None])
        letters, target = turns.arcs(part, known, np.array([last]))
        return known, letters, *turns.ranked(letters, target)

    whole = spans(0, len(rows))
    known, letters, rank, pointers = solved(whole, turns.END, True)
    assert known[0, 0] == cost
    (line,) = turns.audits(np.array([0]), letters, rank, pointers)
    assert line.decode() == audit
    assert turns.repaired(line, 0, [r for r, _ in plain], [x for _, x in plain]) == list(out)
    cut = min(cut, len(rows))
    one, two = spans(0, cut), spans(cut, len(rows))
    end = (turns.transfers(two)[0] + turns.END).min(axis=1)
    known, letters, rank, pointers = solved(one, end, False)
    (first,) = turns.audits(np.array([0]), letters, rank, pointers)
    state = int(pointers[-1][0] % 4)
    assert known[0, 0] == cost
    known, letters, rank, pointers = solved(two, turns.END, True)
    (second,) = turns.audits(np.array([state]), letters, rank, pointers)
    assert (first + second).decode() == audit


def test_ranks_are_the_order_of_audits():
    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 12, 40)
    first = np.concatenate([[0], np.cumsum(sizes)])
    n = int(first[-1])
    spans = turns.Spans(first, rng.integers(0, 4, n), rng.random(n) < 0.2, rng.random(n) < 0.2)
    known = turns.costs(spans, np.broadcast_to(turns.END, (40, 4)))
    letters, target = turns.arcs(spans, known, np.ones(40, bool))
    rank, pointers = turns.ranked(letters, target)
    nodes = np.arange(known.size)
    lines = turns.audits(nodes, letters, rank, pointers)
    order = sorted(set(lines))
    assert [order.index(x) for x in lines] == rank.tolist()


def check(spark, convs, span_rows):
    rows = [(c, t, r, x, "k", 1) for c, some in convs.items() for t, r, x in some]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, cost string, place int").repartition(5)
    got = {r.conv_id: r.asDict() for r in repair.repair(frame, span_rows).collect()}
    assert set(got) == set(convs)
    for c, some in convs.items():
        assert got[c] == {"conv_id": c, **wanted(some)}, (c, some)


@pytest.mark.parametrize("rows", [4096, 3])
def test_conversations_whole_and_in_spans(spark, rows):
    rng = random.Random(rows)
    convs = {c: conversation(rng, rng.randrange(1, 9)) for c in range(60)}
    convs[None] = conversation(rng, 12)
    convs[100] = conversation(rng, 400)
    convs[101] = [(1, "user", "same.")] * 150 + [(2, "assistant", "fine.")]
    convs[102] = [(None, None, None), (None, "user", "Hi."), (3, "assistant", "Word. " * 3000), (9, "user", "bye"), (9, "user", "bye")]
    convs[103] = [(t, "user" if t % 2 else "assistant", f"{t}.") for t in range(1, 300)]
    check(spark, convs, rows)


def test_absent_rows_and_an_empty_table(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, present boolean"
    rows = spark.createDataFrame([(1, 1, "user", "Hi.", False), (2, 1, "user", "Hi.", True), (2, 4, "user", "Hi.", False)], schema)
    got = {r.conv_id: r for r in repair.repair(rows).collect()}
    assert got[1].asDict() == {"conv_id": 1, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    assert (got[2].audit, got[2].cost, got[2].gaps) == ("KI", 2, 0)
    assert repair.repair(rows.limit(0)).count() == 0


def test_the_named_query_damages_and_repairs_all(spark, sf_dir):
    given_rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    convs: dict = {r.conv_id: [] for r in given_rows}
    for r in given_rows:
        role, text = r.role or " ", " " if r.text is None else r.text
        fate = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        convs[r.conv_id] += [(r.turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    got = {r.conv_id: r.asDict() for r in repair.op12_conversation_repair(spark, sf_dir).collect()}
    assert got == {c: {"conv_id": c, **wanted(some)} for c, some in convs.items()}
