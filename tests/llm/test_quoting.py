import re

from provender.llm import quoting

ROWS = [
    (1, 0, "user", "Hello there.\n\nHow is the  plan?"),
    (1, 1, "assistant", "> How is the plan?\n\nIt is fine."),
    (1, 2, "user", "Another start"),
    (1, 3, "user", ">> how IS the plan?\n> It is fine.\nGood."),
    (1, 4, "assistant", "> Another start\nyes"),
    (1, 5, None, "> never said\nhm"),
    (1, 6, "user", "> Good.\n> Hello there.\r\nBye\n\n"),
    (2, 0, "user", "> How is the plan?\n"),
    (2, 1, "user", None),
    (2, 1, "user", ""),
    (2, 2, "user", "> one\n> two\nthree"),
    (2, 3, "user", "one\ntwo"),
    (None, 0, "user", "> x"),
    (3, None, "user", "x"),
]


def runs(text):
    out = []
    for line in re.split(r"\r?\n", text or ""):
        mark = re.match(r"^[ \t]*(?:>[ \t]?)+", line)
        level, rest = (mark[0].count(">"), line[mark.end():]) if mark else (0, line)
        if out and out[-1][0] == level and (not out[-1][1][-1].strip(" ")) == (not rest.strip(" ")):
            out[-1][1].append(rest)
        else:
            out.append((level, [rest]))
    return [(level, "\n".join(lines)) for level, lines in out]


def by_hand(rows):
    norm = lambda t: " ".join(t.split()).lower()
    answer = []
    for n, (conv, turn, _, text) in enumerate(rows):
        body = "\n".join(t for level, t in runs(text) if level == 0).strip()
        quotes = [(level, norm(t)) for level, t in runs(text) if level and norm(t)]
        found = []
        if conv is not None and turn is not None:
            for level, q in quotes:
                origins = [t2 for c2, t2, _, x2 in rows if c2 == conv and t2 is not None
                           for lv, p in runs(x2) if lv == 0 and norm(p) == q]
                if origins and min(origins) < turn:
                    found.append((-level, min(origins)))
        else:
            quotes = []
        answer.append([n, conv, turn, body, len(quotes), len(found), max(found)[1] if found else None])
    up = {}
    for _, conv, turn, *_, reply in answer:
        if conv is not None and turn is not None:
            up[conv, turn] = max((x for x in (up.get((conv, turn)), reply) if x is not None), default=None)
    for a in answer:
        root = a[2]
        while a[1] is not None and root is not None and up.get((a[1], root)) is not None:
            root = up[a[1], root]
        a.append(root)
    return answer


def test_links_threads_and_order(spark):
    df = spark.createDataFrame([(n, *r, "old") for n, r in enumerate(ROWS)], "n int, conv_id long, turn long, role string, text string, body string")
    got = {r.n: r for r in quoting.link_quotes(df.repartition(3)).collect()}
    wanted = by_hand(ROWS)
    assert len(got) == len(ROWS)
    for n, _, _, body, quotes, linked, reply, root in wanted:
        r = got[n]
        assert (r.body, r.quotes, r.linked, r.reply_to, r.thread) == (body, quotes, linked, reply, root), n
        assert ">" not in r.formatted.split("|>\n", 1)[1]
    for conv in (1, 2):
        order = sorted((a[7], a[2], a[0]) for a in wanted if a[1] == conv)
        mine = sorted((r.position, r.turn) for r in got.values() if r.conv_id == conv)
        assert [t for _, t in mine] == [t for _, t, _ in order]
        assert [p for p, _ in mine] == list(range(1, len(order) + 1))
        assert all(r.reply_to is None or any(x.turn == r.reply_to and x.position < r.position
                                             for x in got.values() if x.conv_id == conv) for r in got.values() if r.conv_id == conv)
    assert got[12].position is None and got[13].position is None
    assert got[5].formatted.startswith("<|unknown|>\n")


def test_long_conversation_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(quoting, "CHUNK", 4)
    rows = [(7, t, "user", f"message {t}" if t % 3 else f"> message {t // 2}\nanswer {t}") for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = sorted((r.position, r.turn, r.thread) for r in quoting.link_quotes(df).collect())
    wanted = by_hand(rows)
    assert [(t, th) for _, t, th in got] == [(t, th) for th, t in sorted((a[7], a[2]) for a in wanted)]
    assert [p for p, *_ in got] == list(range(1, 61))


def test_empty_table(spark):
    assert quoting.link_quotes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
