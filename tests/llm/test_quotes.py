import random

from assocframe.llm import quotes as Q

SCHEMA = "conv_id long, turn int, role string, text string"


def plain(rows):
    """Answers of each key by looking at every earlier message."""
    small = lambda k: tuple((x is not None, x or 0) for x in k)
    keys = sorted({(c, t) for c, t, *_ in rows}, key=small)
    own = {k: set() for k in keys}
    asked = {k: set() for k in keys}
    for c, t, _, text in rows:
        mine, passages = Q.parse(text)
        own[(c, t)] |= Q.own_digests(mine)
        asked[(c, t)] |= {(n, Q.digest(p)) for n, p in passages if Q.digest(p) is not None}
    found = {}
    for k in keys:
        links = []
        for level, passage in asked[k]:
            inside = [o for o in keys if o[0] == k[0] and passage in own[o]]
            anywhere = [o for o in keys if passage in own[o]]
            # The first holder of the own conversation, or else of all, if it comes before.
            for holders in (inside, anywhere):
                if holders and small(holders[0]) < small(k):
                    links.append((-level, small(holders[0]), holders[0]))
                    break
        found[k] = (max(links)[2] if links else None, len(links))
    roots = {}
    for k in keys:
        depth, at = 0, k
        while found[at][0] is not None:
            at, depth = found[at][0], depth + 1
        roots[k] = (at, depth)
    return found, roots


def check(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA + ", own string, key string").repartition(3)
    got = Q.reply_conversations(df).collect()
    assert len(got) == len(rows)
    found, roots = plain(rows)
    for r in got:
        k = (r["conv_id"], r["turn"])
        parent, n = found[k]
        assert (r["answers_conv"], r["answers_turn"]) == (parent or (None, None)), k
        assert r["n_linked"] == n and ((r["thread_conv"], r["thread_turn"]), r["depth"]) == roots[k]
        assert not any(line.lstrip(" \t").startswith(">") for line in r["text"].split("\n"))
    assert sorted(r["text"] for r in got) == sorted(Q.parse(t)[0] for *_, t in rows)
    return {(r["conv_id"], r["turn"]): r for r in got}


def test_levels_and_passages():
    own, passages = Q.parse("Hi\n> a\n> b\n>> c\n > > d\n>\nyes\n> e")
    assert own == "Hi\nyes"
    assert passages == [(1, " a\n b"), (2, " c\n d"), (1, ""), (1, " e")]
    assert Q.digest(" A  b\n c ") == Q.digest("a B C") and Q.digest(" \n") is None
    assert Q.parse(None) == ("", [])


def test_a_thread(spark):
    rows = [
        (1, 0, "u", "Hello  there\nfriend\n\nsecond paragraph"),
        (1, 1, "a", "> hello there\n> friend\nyes"),
        (1, 2, "u", ">> hello there friend\n> yes\nok then"),
        (2, 0, "u", "> second paragraph\nfrom afar"),
        (3, 0, "u", "> > > yes\n> ok then\n text"),
    ]
    got = check(spark, rows)
    assert [got[k]["depth"] for k in ((1, 0), (1, 1), (1, 2), (2, 0), (3, 0))] == [0, 1, 2, 1, 3]


def test_quotes_of_the_given_conversations(spark, small):
    """Each turn quotes an earlier one, whole or in part, rewrapped and with its quotes."""
    rng = random.Random(6)
    given = spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").limit(80).collect()
    texts, rows = {}, []
    for r in given:
        text = r["text"]
        before = [k for k in texts if k[0] == r["conv_id"]] or ([rng.choice(list(texts))] if texts and rng.random() < 0.5 else [])
        if before:
            whole = texts[rng.choice(before)].split("\n")
            part = whole if rng.random() < 0.5 else [rng.choice(whole)]
            text = "\n".join(">" * rng.choice((1, 1, 2)) + " " + line.replace(" ", "  ", 1) for line in part) + "\n" + text
        texts[(r["conv_id"], r["turn"])] = text
        rows.append((r["conv_id"], r["turn"], r["role"], text))
    got = check(spark, rows)
    assert sum(r["depth"] > 0 for r in got.values()) > 20


def test_long_chains(spark):
    rows = [(1, t, "u", (f"> message {t - 1}\n" if t else "") + f"message {t}") for t in range(70)]
    got = check(spark, rows)
    assert got[(1, 69)]["depth"] == 69


def test_odd_messages(spark):
    rows = [
        (None, None, None, "> nobody said this\n>\nq"), (None, 0, "u", "one"), (1, None, "u", "> one\ntwo"), (1, 1, "u", None),
        (1, 2, "u", ""), (1, 3, "u", "> same\nsame"), (1, 3, "u", "> two\nsame"), (2, 0, "u", "> two\n> \n>> one\n" + "x " * 90_000),
    ]
    check(spark, rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert Q.reply_conversations(empty).isEmpty()
