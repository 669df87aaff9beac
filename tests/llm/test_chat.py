from gleaner.llm import chat


def test_maximal(spark):
    conv = {
        1: [("user", "a")], 2: [("user", "a"), ("bot", "b")], 3: [("user", "a"), ("bot", "b")], 4: [("user", "a"), ("bot", "c"), ("user", "d")],
        5: [("user", "a"), ("bot", "c")], 6: [("bot", "b"), ("user", "a")], 7: [(None, None)], 8: [("", "")], 9: [("use", "ra")],
    }
    rows = [(c, 10 * i, r, t, 5) for c, turns in conv.items() for i, (r, t) in enumerate(turns)]
    rows += [(None, 0, "user", "lost", 5), (10, 0, "user", "twice", 5), (10, 0, "user", "twice", 5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    conv[10] = [("user", "twice")] * 2
    key = {c: tuple((r or "", t or "") for r, t in x) for c, x in conv.items()}
    want = {
        c: x for c, x in key.items()
        if not any(len(y) > len(x) and y[: len(x)] == x for y in key.values()) and c == min(d for d, y in key.items() if y == x)
    }
    out = {r.conv_id: r for r in chat.rendered(turns).collect()}
    assert out.keys() == want.keys()
    for c, x in want.items():
        assert out[c].n_turns == len(x)
        assert out[c].rendered == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in x)
    assert chat.rendered(turns.where("false")).count() == 0
