"""Trimmed, multi-paragraph and interleaved quotes against a plain search for the quoted lines in all earlier messages."""

import random

from assocframe.llm import quotes as Q

SCHEMA = "conv_id long, turn int, role string, text string"


def lines_of(text):
    return [" ".join(x.lower().split()) for x in text.split("\n") if x.strip()]


def holds(own, quoted):
    return any(own[i : i + len(quoted)] == quoted for i in range(len(own) - len(quoted) + 1))


def answers(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {(r["conv_id"], r["turn"]): (r["answers_conv"], r["answers_turn"]) for r in Q.reply_conversations(df).collect()}


def test_named_cases(spark):
    rows = [
        (1, 0, "u", "one\ntwo\nthree\n\nfour\nfive\n\nsix"),
        (1, 1, "a", "> two\n> three\ntrimmed"),
        (1, 2, "u", "> one two\n> three\n>\n> four\n> five\nparagraphs, the first one wrapped anew"),
        (1, 3, "a", "a\nb\n> six\nc\nd"),
        (1, 4, "u", "> a\n> b\n>> six\n> c\n> d\nuntrimmed"),
        (1, 5, "u", "> three\n> four\nover a blank line"),
        (1, 6, "u", "> nobody's words\n> at all\nnothing"),
    ]
    got = answers(spark, rows)
    assert [got[(1, t)] for t in range(7)] == [(None, None), (1, 0), (1, 0), (1, 0), (1, 3), (1, 0), (None, None)]


def test_quotes_are_found_where_their_lines_are(spark):
    rng, rows, own, want = random.Random(3), [], {}, {}
    for n in range(150):
        key, text = (n // 50, n % 50), []
        if n % 50:
            origin = (key[0], rng.randrange(key[1]))
            runs = own[origin]
            chosen = rng.choice(runs) if rng.random() < 0.5 else None
            if chosen:  # some lines in a row of one of its runs
                real = [i for i, x in enumerate(chosen) if x]
                a, b = sorted((rng.choice(real), rng.choice(real)))
                quoted = [chosen[a : b + 1]]
            else:
                quoted = runs
            for k, run in enumerate(quoted):
                text += ([">> in between"] if k else []) + ["> " + x.replace(" ", "  ") for x in run]
            # The first message with the lines of every quoted run, in a row.
            holders = [o for o in own if o[0] == key[0] and all(holds(sum(map(lines_of, map("\n".join, own[o])), []), lines_of("\n".join(q))) for q in quoted)]
            want[key] = holders[0]
        mine = []
        for k in range(rng.randrange(1, 4)):
            run = [rng.choice(("Ok", "Yes then", "")) if rng.random() < 0.3 else f"Line {rng.randrange(10**6)} of {n}" for _ in range(rng.randrange(2, 9))]
            run = [f"Start {k} of {n}", *run, f"End {k} of {n}"]
            mine.append(run)
            text += (["> nobody said"] if k or text else []) + run if k else run
        own[key] = mine
        rows.append((*key, "u", "\n".join(text)))
    got = answers(spark, rows)
    unclear = {k for k, o in want.items() if got[k] != o}
    assert len(want) == 147 and not unclear


def test_lines_in_a_row():
    text = "A  b\n\nc\nd"
    every = {Q.digest(x) for x in ("a b", "c", "d", "a b c", "c d", "a b c d")}
    assert Q.own_digests(text) == every
    assert Q.own_digests(text, [2]) == every - {Q.digest("c"), Q.digest("d")}


def test_runs_of_a_long_message():
    lines = [f"line {i % 7} w{i}" for i in range(50_000)]
    found = Q.own_digests("\n".join(lines), [3, 40_000])
    assert len(found) == 2 + 49_998 + 10_001 - 1  # the whole text is its one paragraph too
    assert {Q.digest("\n".join(lines[k : k + n])) for k, n in ((0, 3), (777, 3), (49_997, 3), (0, 40_000), (10_000, 40_000))} <= found
