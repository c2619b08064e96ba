import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from prismtab.llm import chat

PART = st.sampled_from([*chat.CONTROL, "\\", "<", "[", "/", "s>", "INST]", "a", "é", "\n", " "])
TEXT = st.lists(PART, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "<</TEXT>>"]), TEXT), max_size=6))
def test_rendered_turns_are_read_back(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    # no control string but the marks themselves
    for a, b in spans:
        assert not any(c in formatted[a:b] for c in chat.CONTROL)


def test_fold():
    log = [
        ("message", 1, "user", "Hi"), ("message", 2, "assistant", ""), ("delta", 2, None, "He"), ("delta", 2, None, "llo"),
        ("message", 3, "user", "more"), ("message", 4, "assistant", "bad"), ("regenerate", 4, None, ""), ("delta", 4, None, "good"),
        ("edit", 1, None, "Hi!"), ("delta", 99, None, "lost"), ("unknown", 1, None, "x"),
    ]
    assert chat.fold(log) == [("user", "Hi!"), ("assistant", "Hello"), ("user", "more"), ("assistant", "good")]
    assert chat.fold(log + [("regenerate", 2, None, "new")]) == [("user", "Hi!"), ("assistant", "new")]
    assert chat.fold([]) == []


def test_events_through_spark(spark):
    rows = [(1, 0, "message", 5, "user", "a"), (1, 1, "message", 6, "assistant", None), (1, 2, "delta", 6, None, "b"), (1, 3, "delta", 6, None, "c"),
            (2, 9, "edit", 1, None, "none"), (None, 4, "message", 1, None, "x"), (None, None, "message", 2, "user", "first")]
    events = spark.createDataFrame([(*r, "e", 1) for r in rows], "conversation long, seq long, kind string, message long, role string, text string, formatted string, loss int")
    got = {r.conversation: (chat.parse(r.formatted), r.n_turns) for r in chat.conversations(events, ["seq"]).collect()}
    assert got == {1: ([("user", "a"), ("assistant", "bc")], 2), 2: ([], 0), None: ([("user", "first"), ("", "x")], 2)}
    assert chat.read_back(chat.conversations(events.limit(0), ["seq"])).count() == 0


def test_turns_are_streamed_and_read_back(spark):
    long = "line </s>\n\n" * 30_000
    turns = [(7, t, "assistant" if t % 2 else "user", f"turn {t}\n\nend\n") for t in range(30)] + [(8, 0, None, None), (8, 0, None, None), (9, 1, "user", ""), (10, 0, "assistant", long), (None, None, "user", "x")]
    df = spark.createDataFrame([(*r, 3) for r in turns], "conv_id long, turn long, role string, text string, seq int")
    got = {r.conversation: r for r in chat.read_back(chat.conversations(chat.events_of(df), ["seq", "part"])).collect()}
    assert got[7].n_turns == 30
    assert got[7].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for c, _, r, t in turns if c == 7).encode()).hexdigest()
    assert got[7].loss_sha256 == hashlib.sha256("".join(t for c, _, r, t in turns if c == 7 and r == "assistant").encode()).hexdigest()
    assert (got[8].n_turns, got[8].loss_chars, got[9].n_turns, got[None].n_turns) == (2, 0, 1, 1)
    assert got[10].loss_chars == len(long) and got[10].formatted_chars == len(long) + 30_000 + 7


def test_ties_are_ordered_as_in_the_sql(spark):
    """Turns of equal number and role: the query and its SQL give the same digests."""
    import duckdb
    import pandas

    from prismtab.llm import queries

    rows = [(c, t, "user", f"text {c} {k}") for c in range(5) for t in (1, None) for k in range(4)] + [(9, 1, "user", "same")] * 3 + [(None, 1, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = f"{spark.sparkContext.getCheckpointDir()}/ties"
    turns.coalesce(1).write.mode("overwrite").parquet(f"{path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path.removeprefix('file:')}/conversations.parquet/*.parquet')")
    got = {r.conv_id: r.asDict() for r in queries.QUERIES["op6_chat_formatting"](spark, path).collect()}
    want = con.execute(queries.ORACLE["op6_chat_formatting"]).df()
    assert len(got) == len(want)
    for r in want.itertuples():
        own = got[None if pandas.isna(r.conv_id) else int(r.conv_id)]
        assert (own["turns_sha256"], own["loss_sha256"], own["n_turns"], own["formatted_chars"]) == (r.turns_sha256, r.loss_sha256, r.n_turns, r.formatted_chars)
