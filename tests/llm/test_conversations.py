"""Operator 13 against a search over all edits, written anew."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from treadle.llm import conversations, queries

SPACE = re.compile(r"[\x20\x09-\x0D]*\Z")
SCHEMA = "conv_id long, turn long, role string, text string, conv string, g long, copies long, letters string, kind int"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        role, text = name(role), name(text)
        draw = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))


def expected(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash, messages) of one conversation's rows."""
    rows = ordered(rows)
    seen, found = set(), []
    for _, _, role, text in rows:
        last = SPACE.sub("", text)[-1:]
        fault = "b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else ""
        seen.add((role, text))
        found.append(fault)
    # automaton of s?(ua)+ or nothing: state -> letter -> state
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    best = {}  # (row, state) -> (cost, audit, messages), from the end, with at most two inserts in a row
    for k in range(len(rows), -1, -1):
        level = {}
        for inserts in (2, 1, 0):
            now = {}
            for state in moves:
                options = []
                if k == len(rows):
                    if state in ("", "a"):
                        options.append((0, "", ()))
                else:
                    _, _, role, text = rows[k]
                    c, a, m = best[k + 1, state]
                    options.append((3 + c, "D" + a, m))
                    if found[k] not in ("b", "d"):
                        more = int(found[k] == "t")
                        if role[:1] in moves[state]:
                            c, a, m = best[k + 1, moves[state][role[:1]]]
                            options.append((more + c, "K" + a, ((role, text), m)))
                        for name in ("user", "assistant"):
                            if name[0] in moves[state]:
                                c, a, m = best[k + 1, moves[state][name[0]]]
                                options.append((2 + more + c, "R" + a, ((name, text), m)))
                if inserts < 2:
                    for name in ("user", "assistant"):
                        if name[0] in moves[state] and moves[state][name[0]] in level:
                            c, a, m = level[moves[state][name[0]]]
                            options.append((2 + c, "I" + a, ((name, ""), m)))
                if options:
                    now[state] = min(options, key=lambda o: o[:2])
            level = now
        best.update({(k, s): v for s, v in level.items()})
    cost, audit, chain = best[0, ""]
    messages = []
    while chain:
        message, chain = chain
        messages.append(message)
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("b"), found.count("d"), found.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest(), messages)


def random_rows(conv, n, own, roles=("user", "assistant", "system", None, "Usher", "ape", "", "user", "assistant")):
    texts = ["Yes.", "no", "What? ", " ", "", None, "a.b", "é!\n", "end"]
    return [(conv, own.choice([k, k, k + own.randint(0, 3), None]), own.choice(roles),
             own.choice(texts) if own.random() < 0.4 else f"text {own.randint(0, 10 ** 6)}" + own.choice(["", ".", "!"])) for k in range(n)]


def frames(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SCHEMA).repartition(parts)


def check(spark, rows, **options):
    given = frames(spark, rows)
    messages = conversations.damage(given)
    found = conversations.edits(spark, messages, **options)
    got = {r[0]: tuple(r)[1:] for r in conversations.summaries(messages, found, given.selectExpr("conv_id as conv").distinct()).collect()}
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    assert set(got) == set(by)
    written = {}
    for r in conversations.repaired_messages(messages, found).orderBy("position").collect():
        written.setdefault(r.conv, []).append((r.role, r.text))
    for conv, own in by.items():
        *want, said = expected(own)
        assert got[conv] == tuple(want), conv
        assert written.get(conv, []) == said, conv


def test_random_conversations(spark):
    own = random.Random(5)
    rows = [r for conv in [None, *range(150)] for r in random_rows(conv, own.choice([1, 2, 3, 8, 30]), own)]
    check(spark, rows)


@pytest.mark.parametrize("passes", [0, 1, 4])
def test_chunks_of_a_long_conversation_are_stitched(spark, passes):
    own = random.Random(passes)
    mixed = random_rows(1, 400, own)
    alternating = [(2, k, ("user", "assistant")[k % 2], f"t{k}.") for k in range(300)]
    # costs of a run of one role depend on its parity, so chunks of it never converge
    users = [(3, k, "user", f"t{k}.") for k in range(300)]
    copies = [(4, k, "assistant", "the same.") for k in range(300)] + [(4, 7, "assistant", "the same.")] * 20
    systems = [(5, k, "system", f"t{k}") for k in range(200)]
    check(spark, mixed + alternating + users + copies + systems, passes=passes, chunk=8)


def test_fixing_up_gives_what_a_whole_run_gives():
    own = random.Random(9)
    for _ in range(300):
        codes = bytes(own.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(own.randint(0, 30)))
        old, new = (tuple(conversations.closed(own.randint(0, 6) for _ in range(4))) for _ in range(2))
        old, new = (tuple(c - min(v) for c in v) for v in (old, new))
        front = conversations.front_of(codes, old)
        assert conversations.fixed(codes, old, new, front) == conversations.front_of(codes, new)
        m = conversations.matrix_of(codes)
        by_matrix = [min(m[q * 4 + r] + new[r] for r in range(4)) for q in range(4)]
        assert tuple(c - min(by_matrix) for c in by_matrix) == conversations.front_of(codes, new)


def test_empty_and_wholly_dropped(spark):
    given = frames(spark, [])
    messages = conversations.damage(given)
    assert conversations.summaries(messages, conversations.edits(spark, messages), given.selectExpr("conv_id as conv")).count() == 0
    dropped = [(c, 0, "user", "hi.") for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert dropped
    check(spark, dropped)


def test_query(spark, tmp_path):
    own = random.Random(2)
    rows = [r for conv in range(20) for r in random_rows(conv, 6, own)]
    frames(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_conversations(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.count() == 20
