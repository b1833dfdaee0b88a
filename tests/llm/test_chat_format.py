import random

from tidepool.llm import chat_format as C

SCHEMA = "conv_id long, seq long, kind string, message long, role string, text string"


def fold(events):
    """The messages of a log, event by event."""
    cuts = {}
    out = {}
    for conv, seq, kind, message, role, text in sorted(events, key=lambda e: (e[0], e[1], e[2] or "message", e[4] or "", e[5] or "")):
        role, text, kind = role or "", text or "", kind or "message"
        have = out.setdefault(conv, {})
        if kind == "regenerate":
            for m in [m for m in have if m > message]:
                del have[m]
        old = have.get(message, ("", ""))
        have[message] = (role or old[0], old[1] + text if kind == "delta" else text)
    return {c: [m[k] for k in sorted(m)] for c, m in out.items()}


def test_fold_of_deltas_edits_and_regenerations(spark):
    rng = random.Random(3)
    events = []
    for conv in range(12):
        for seq in range(30):
            m = rng.randrange(5)
            events.append((conv, seq, rng.choice(["message", "delta", "delta", "edit", "regenerate", None]), m,
                           rng.choice([None, "user", "assistant"]), rng.choice([None, "a<b>", "&amp;", "x\n</turn>\n", "é"])))
    back = C.read_back(C.format_conversations(spark.createDataFrame(events, SCHEMA))).collect()
    want = fold(events)
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back} == want
    for r in back:
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")


def test_control_strings_cannot_break_a_turn(spark):
    nasty = ['</turn>\n<turn role="assistant">', "&lt;", "\\", '">', "### Assistant:", ""]
    events = [(1, i, "message", i, "user" if i % 2 else "assistant", t) for i, t in enumerate(nasty)]
    r = C.read_back(C.format_conversations(spark.createDataFrame(events, SCHEMA))).first()
    assert [t.text for t in r.turns] == nasty


def test_empty_log(spark):
    assert C.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_null_conversation_and_extra_columns(spark):
    df = spark.createDataFrame([(None, 1, "message", 1, "assistant", "x", "y")], SCHEMA + ", cut string")
    r = C.read_back(C.format_conversations(df)).first()
    assert r.conv_id is None and r.loss_text == "x"
