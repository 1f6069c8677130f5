import pytest

from zilverspoor.checks.compare import compare
from zilverspoor.llm import quote_linking as q
from zilverspoor.llm.queries import QUOTE_SQL, queries

MESSAGES = [
    (1, 0, "a", "Hello there\nhow are you?\n\nSecond paragraph here"),
    (1, 1, "b", "Ann wrote:\n> hello   THERE\n> how are you?\n\nFine, thanks"),
    (1, 2, "c", "My own start"),
    (1, 3, "a", "b wrote:\n> Ann wrote:\n> > Hello there\n> Fine, thanks\nGood!"),
    (1, 4, "d", ">> second paragraph here\n> My own start\nboth"),
    (1, 5, "d", "> nobody ever said this\nodd"),
    (1, 6, "e", "> Hello there\n> My own start"),
    (2, 0, "a", "> Hello there\nanother conversation"),
    (2, 7, "a", "gap before"),
    (2, 8, "a", "> gap before"),
    (3, 1, "x", None),
    (3, 2, "x", ""),
    (3, 2, "y", "same turn"),
    (3, 3, "z", "> same turn\n\n\n  \nreply  "),
    (4, 0, "x", "a > b is no quote\n  > but this is"),
    (4, 1, "x", "   >   a > b is no quote"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(MESSAGES, SCHEMA)


def test_links_and_texts(frame):
    rows = q.conversations(frame).collect()
    assert len(rows) == len(MESSAGES)
    got = {(r["conv_id"], r["turn"], r["role"]): r for r in rows}
    assert got[1, 1, "b"]["text"] == "Fine, thanks" and got[1, 1, "b"]["reply_to"] == 0
    assert got[1, 3, "a"]["text"] == "Good!" and got[1, 3, "a"]["reply_to"] == 1
    assert got[1, 4, "d"]["reply_to"] == 2 and got[1, 4, "d"]["text"] == "both"
    assert got[1, 5, "d"]["reply_to"] == 4 and got[1, 5, "d"]["matched"] == 0
    assert got[1, 6, "e"]["reply_to"] == 2 and got[1, 6, "e"]["text"] == ""
    assert got[2, 0, "a"]["reply_to"] is None and got[2, 7, "a"]["reply_to"] is None
    assert got[2, 8, "a"]["thread"] == 7
    assert got[3, 3, "z"]["reply_to"] == 2 and got[3, 1, "x"]["text"] is None
    assert got[4, 1, "x"]["matched"] == len("a > b is no quote")
    order = sorted(rows, key=lambda r: (r["conv_id"], r["thread"], r["depth"], r["turn"]))
    seen = set()
    for r in order:
        assert r["reply_to"] is None or (r["conv_id"], r["reply_to"]) in seen
        seen.add((r["conv_id"], r["turn"]))


def test_nested_levels_link_to_their_own_messages(frame):
    found = q.links(q.parsed(frame, "conv_id", "turn", "role", "text"))
    got = {(r["conv"], r["turn"], r["origin"], r["level"]) for r in found.collect()}
    assert {(1, 3, 1, 1), (1, 3, 0, 2), (1, 4, 0, 2), (1, 4, 2, 1)} <= got


def test_against_sql(frame):
    import duckdb

    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    # SQL strings of one turn would be thrown together
    rows = [m for m in MESSAGES if m[:2] != (3, 2)]
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    some = frame.filter("NOT (conv_id = 3 AND turn = 2)")
    assert compare(q.conversations(some), connection, QUOTE_SQL) is None


def test_awkward_rows(spark, awkward):
    rows = [(i % 4, i, "r", t, i) for i, t in enumerate(awkward)]
    rows += [(None, 1, "r", "> x", 0), (1, None, "r", "y", 0), (None, None, None, None, None)]
    rows += [(9, 0, "r", "same", 1)] * 2
    frame = spark.createDataFrame(rows, SCHEMA + ", depth long")
    out = q.conversations(frame).collect()
    assert len(out) == len(rows)
    assert sorted(str(r["text"]) for r in out if r["conv_id"] is not None and r["turn"] is not None and r["conv_id"] < 9) == sorted(map(str, awkward))
    assert q.conversations(frame.limit(0)).count() == 0


def test_long_threads(spark):
    rows = [(1, i, "r", f"message {i}") for i in range(70)]
    out = q.conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["turn"], r["depth"], r["thread"]) for r in out} == {(i, i, 0) for i in range(70)}


def test_quotes_in_the_given_conversations_are_linked(spark, folder):
    rows = queries()["quoting_conversations"](spark, folder).collect()
    linked = [r for r in rows if r["matched"]]
    assert len(linked) > len(rows) // 4 and not any(">" in (r["text"] or "") for r in rows)
    assert sum(r["conv_id"] == -1 for r in rows) > len(rows) // 4
    # the first message quoted at the end is answered, not the one before
    assert any(r["turn"] - r["reply_to"] > 1 for r in linked if r["conv_id"] != -1)
