"""Conversations in reply order without quotes, against a plain version that tries every pair of messages."""

from __future__ import annotations

import random

import pytest

from tripforge.llm import quotations
from tripforge.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def levels(text):
    """Own lines and (level, lines) of the quoted runs."""
    own, runs, before = [], [], 0
    for line in text.split("\n"):
        rest, level = line.lstrip(" \t"), 0
        while rest.startswith(">"):
            rest, level = rest[1:].lstrip(" \t"), level + 1
        if not level:
            own.append(line)
        elif level == before:
            runs[-1][1].append(rest)
        else:
            runs.append((level, [rest]))
        before = level
    return ("\n".join(own).strip("\n") if runs else text), [(n, "\n".join(x)) for n, x in runs]


def plain_original(conv, turn, block, rows):
    """Of all messages, tried one by one, the original of a block."""
    wanted = quotations.passages(block)
    holders = [(c, t, quotations.passages(levels(x)[0])) for c, t, _, x in rows if None not in (c, t, x)]
    for passage in wanted:
        own = [t for c, t, held in holders if c == conv and (turn is None or t < turn) and passage in held]
        if own:
            return conv, max(own)
    for passage in wanted:
        others = [(c, t) for c, t, held in holders if c != conv and passage in held]
        if others:
            return min(others)
    return None


def plain_conversations(rows):
    groups = {}
    for n, row in enumerate(rows):
        groups.setdefault(row[0] if row[0] is not None else f"lone {n}", []).append(row)
    result = []
    for group in groups.values():
        group = sorted(group, key=lambda r: [(v is None, 0 if v is None else v) for v in r[1:]])
        made, children = [], {}
        for place, (conv, turn, role, text) in enumerate(group):
            own, runs = levels(text) if text is not None else (None, [])
            quotes, orphans = [], []
            for level, block in runs:
                original = plain_original(conv, turn, block, rows)
                (quotes if original else orphans).append((level, *original) if original else (level, block))
            near = [(-level, t) for level, c, t in quotes if c == conv and conv is not None]
            parent = place - 1
            if near:
                parent = max(i for i, r in enumerate(group) if r[1] == max(near)[1])
            children.setdefault(parent, []).append(place)
            made.append((turn, role, own, group[parent][1] if parent >= 0 else None, tuple(quotes), tuple(orphans)))

        def walk(place):
            yield place
            for child in children.get(place, []):
                yield from walk(child)

        order = [p for root in children[-1] for p in walk(root)]
        result.append((group[0][0], tuple(made[p] for p in order)))
    return sorted(result, key=repr)


def formed(spark, rows):
    found = quotations.conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted(
        (
            (
                r["conv_id"],
                tuple(
                    (m["turn"], m["role"], m["text"], m["reply_to"], tuple(map(tuple, m["quotes"])), tuple(map(tuple, m["orphans"])))
                    for m in r["messages"]
                ),
            )
            for r in found
        ),
        key=repr,
    )


def test_levels_of_lines():
    text = "hello\n> one\n>two\n>> deep\n > > deep too\nown > text\n>\n> three"
    assert quotations.parse(text) == ("hello\nown > text", [(1, "one\ntwo"), (2, "deep\ndeep too"), (1, "\nthree")])
    assert quotations.parse("a > b") == ("a > b", [])
    assert quotations.passages("Ab, c. D e\nf") == ["ab c d e f", "ab c d e", "d e f", "ab c"] + ["f"]


def test_replies_follow_what_they_quote(spark):
    rows = [
        (1, 0, "user", "Where is the cat? And where is the dog?"),
        (1, 1, "assistant", "The cat is\non the mat."),
        (1, 2, "user", "> and where is   the DOG?\n\nBy the door."),
        (1, 3, "user", ">> where is the cat?\n> The cat is on the mat.\nThanks."),
        (1, 4, "user", "> never written anywhere\nWhat?"),
        (2, 0, "user", "> By the door.\nWhich door?"),
    ]
    got = dict(formed(spark, rows))
    assert [m[0] for m in got[1]] == [0, 1, 3, 4, 2]
    assert [m[2] for m in got[1]][2:] == ["Thanks.", "What?", "By the door."]
    assert got[1][2][4] == ((2, 1, 0), (1, 1, 1)) and got[1][2][3] == 1
    assert got[1][3][5] == ((1, "never written anywhere"),)
    assert got[2] == ((0, "user", "Which door?", None, ((1, 1, 2),), ()),)


@pytest.mark.parametrize("broadcast", [True, False])
def test_planted_quotes_equal_brute_force(spark, settings, monkeypatch, broadcast):
    if not broadcast:
        settings(spark__sql__autoBroadcastJoinThreshold="-1")
        monkeypatch.setattr(quotations, "broadcast_if_small", lambda df: df)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    sentence = lambda: " ".join(rng.choices(words, k=rng.randint(1, 7))).capitalize() + "."
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            own = [rng.choice([" ", "\n", "\n\n"]).join(sentence() for _ in range(rng.randint(1, 4)))]
            own += ["Hot line."] * (rng.random() < 0.4)
            lines = []
            for _ in range(rng.choice([0, 0, 1, 2])):
                marks = rng.choice([">", "> ", ">>", "> > "])
                source = rng.choice([r for r in rows if r[0] == conv] or rows) if rows and rng.random() < 0.8 else None
                quoted = levels(source[3])[0] if source else rng.choice([sentence(), "Hot line."])
                part = quoted.split("\n")[rng.randint(0, 1) :] or [quoted]
                lines += [marks + x.upper() for x in part]
                lines += rng.choice([[], [""], ["Between."]])
            rows.append((conv, turn, rng.choice(["user", "assistant"]), "\n".join([*lines, *own])))
    rows += [
        (0, 0, "user", rows[0][3]),
        (0, None, "user", "> Hot line.\nlast"),
        (None, 3, "user", "> Hot line.\nalone"),
        (None, 3, "user", "> Hot line.\nalone"),
        (None, None, None, None),
        (77, 1, None, ""),
        (78, 1, "user", ">"),
    ]
    expected = plain_conversations(rows)
    assert sum(len(m[4]) for _, c in expected for m in c) > 40
    assert formed(spark, rows) == expected


def test_query_holds_every_message(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    found = QUERIES["op3_quotations"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r["n_messages"] for r in found) == given.count()
    assert len(found) == given.select("conv_id").distinct().count()
    assert formed(spark, []) == []
