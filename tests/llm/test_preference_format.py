from quarry.llm.preference_format import conversations, preference_pairs

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, kind string"


def brute(rows):
    convs = {}
    for conv, turn, role, text in {r[:4] for r in rows}:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, (role if role is not None else "unknown").replace("<|", "<\\|"), (text or "").replace("<|", "<\\|")))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    pairs, first = [], {}
    for c in sorted(convs):
        lead = first.setdefault(convs[c][0], c)
        if lead != c:
            pairs.append(("opening", lead, c, convs[lead], convs[c]))
        at = [i for i, t in enumerate(convs[c]) if t[0] == "assistant"]
        if len(at) > 1:
            pairs.append(("stale", c, c, convs[c][:at[-1] + 1], [*convs[c][:at[-1]], convs[c][at[0]]]))
    out = []
    for kind, a, b, x, y in pairs:
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1

        def render(turns):
            text, spans = "", []
            for role, body in turns:
                text += f"<|{role}|>\n"
                start = len(text)
                text += f"{body}<|end|>\n"
                if role == "assistant":
                    spans.append(f"{start}-{len(text)}")
            return text, ",".join(spans)

        (c, cm), (r, rm) = render(x[n:]), render(y[n:])
        out.append((kind, a, b, n, render(x[:n])[0], c, r, cm, rm))
    return sorted(out)


def run(spark, rows):
    return sorted(map(tuple, preference_pairs(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)).collect()))


def test_edge_cases(spark):
    rows = [(1, 0, "user", "Hi"), (1, 1, "assistant", "A"), (1, 2, "user", "more"), (1, 3, "assistant", "B"),
            (2, 0, "user", "Hi"), (2, 1, "assistant", "A"), (2, 2, "user", "less"), (3, 0, "user", "Hi"), (3, 0, "user", "Hi"),
            (4, 0, None, None), (5, 0, None, ""), (6, None, "user", "first"), (6, 0, "assistant", "é<|end|>"), (6, 1, "assistant", ""),
            (None, 0, "user", "Hi"), (7, 0, "assistant", "x"), (7, 0, "assistant", "y"), (8, 0, "user", "Hi"), (8, 1, "assistant", "A"),
            (9, 0, "user", "w " * 50_000), (9, 1, "assistant", "z"), (9, 2, "assistant", "z"), (10, 1, "assistant", "only")]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_whole_table(spark):
    assert preference_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
    t = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in t.select("conv_id", "turn", "role", "text").collect()]
    got = run(spark, rows)
    assert got == brute(rows) and got
    assert conversations(t).count() == len({r[0] for r in rows})
