from kestrel.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, n_turns int, h string, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def rendered(df):
    return {r.conv_id: (r.n_turns, r.n_copies, r.text) for r in df.collect()}


def test_prefixes_collapse_and_the_longest_stays(spark):
    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    rows = [(cid, t, *turns[t]) for cid, n in ((1, 1), (2, 2), (3, 3), (4, 3)) for t in range(n)]
    rows += [(5, 0, "user", "a"), (5, 1, "assistant", "other")]
    got = rendered(chat.format_chats(table(spark, rows)))
    assert got == {3: (3, 2, "<|user|>\na\n<|assistant|>\nb\n<|user|>\nc\n"),
                   5: (2, 1, "<|user|>\na\n<|assistant|>\nother\n")}


def test_nulls_ties_repeats_and_gaps(spark):
    rows = [(None, 0, "user", "lost"), (1, 0, None, "x"), (1, 7, "user", None), (1, 7, "user", None),
            (2, None, "user", "late"), (2, 3, "user", "early"), (3, 0, "user", ""), (4, 0, "user", None),
            (5, 0, "b", "tie"), (5, 0, "a", "tie")]
    got = rendered(chat.format_chats(table(spark, rows)))
    assert got == {1: (2, 1, "<|unknown|>\nx\n<|user|>\n\n"), 2: (2, 1, "<|user|>\nearly\n<|user|>\nlate\n"),
                   3: (1, 1, "<|user|>\n\n"), 4: (1, 1, "<|user|>\n\n"), 5: (2, 1, "<|a|>\ntie\n<|b|>\ntie\n")}


def test_long_texts_and_many_copies(spark):
    long = "word " * 200_000
    rows = [(i, t, "user", f"hello {t}" if t else long) for i in range(60) for t in range(3 if i == 59 else 2)]
    got = rendered(chat.format_chats(table(spark, rows)))
    assert {k: v[:2] for k, v in got.items()} == {59: (3, 1)}
    assert len(got[59][2]) > len(long)


def test_ties_go_by_role_then_digest(spark):
    import hashlib
    texts = ["b", "a", "c", "", None]
    rows = [(1, 0, role, t) for role in ("y", None, "x") for t in texts] + [(2, None, None, t) for t in texts]
    got = rendered(chat.format_chats(table(spark, rows)))
    order = sorted(texts, key=lambda t: "" if t is None else hashlib.md5(t.encode()).hexdigest())
    part = {r: "".join(f"<|{r or 'unknown'}|>\n{t or ''}\n" for t in order) for r in (None, "x", "y")}
    assert got == {1: (15, 1, part[None] + part["x"] + part["y"])}      # the second is a prefix of the first


def test_a_turn_logged_many_times_is_held_once(spark):
    rows = table(spark, [(1, 0, "user", "again " * 200), (1, 1, "bot", "end"), (2, 0, "user", "other")])
    many = rows.unionByName(rows.where("turn = 0 and conv_id = 1").join(spark.range(100_000), how="cross").drop("id"))
    assert rendered(chat.format_chats(many)) == rendered(chat.format_chats(rows))
    out = chat.format_chats(many)
    sets = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in sets and "partial_collect_set" in sets      # combined before the shuffle


def test_empty_table(spark):
    assert chat.format_chats(table(spark, [])).collect() == []
