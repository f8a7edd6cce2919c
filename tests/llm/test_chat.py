import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import chat
from rillflow.llm.queries import HOSTILE

HARD = st.lists(st.sampled_from([*chat.MARKS, "\\", "<", "s>", "[", "INST]", "x", "é", "\n", "<\\s>", "🙂"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(HARD)
def test_escape_can_be_undone(text):
    coded = chat.escape(text)
    assert chat.unescape(coded) == text and not any(m in coded for m in chat.MARKS)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.booleans()), min_size=1, max_size=9))
def test_mask(parts):
    want = [loss for n, loss in parts for _ in range(n)]
    assert chat.mask([n for n, _ in parts], [x for _, x in parts]).tolist() == want


def test_conversations(spark, monkeypatch):
    rows = [
        (-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE), (1, 0, "system", "be brief"), (1, 2, "assistant", "two"), (1, 1, "user", "one <\\s> \\"),
        (2, 0, "tool[INST]", "odd </s>"), (2, None, "user", None), (2, 1, None, "x"), (3, 0, "assistant", "b"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (None, 0, "user", "null id"), (4, 0, "assistant", "word " * 40_000), (4, 1, "assistant", "\x00\u2028é🙂"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    parts = chat.format_chats(df).cache()
    got = {r.conv_id: r for r in chat.digests(parts).collect()}
    texts = {}
    for r in chat.rendered(parts).orderBy("conv_id", "part").collect():
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
    for c in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in mine)
        loss = "".join(t or "" for _, r, t in mine if r == "assistant")
        row = got[c]
        assert (row.n_turns, row.turns_sha256) == (len(mine), hashlib.sha256(whole.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars == len(texts[c])
        assert texts[c].startswith("<s>") and texts[c].endswith("</s>") and texts[c].count("</s>") == 1
    assert chat.digests(chat.format_chats(df.where("false"))).count() == 0


def test_long_conversations_come_in_parts(spark, monkeypatch):
    df = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", f"turn {i} " * 50) for i in range(200)], "conv_id long, turn long, role string, text string")
    whole = chat.digests(chat.format_chats(df)).collect()
    monkeypatch.setattr(chat, "PART_TOKENS", 500)
    task = chat.format_chats(df)
    assert task.count() >= 1 and chat.digests(task).collect() == whole
