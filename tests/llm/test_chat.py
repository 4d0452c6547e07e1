import pytest

from siltstone.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, seq int, size int, block string, own string, segment string"


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "b", "o", "s") for row in rows], SCHEMA)


def plain(rows):
    found = []
    for conv in {c for c, *_ in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
        for speaker in sorted({r[2] for r in own} - {None, "system"}):
            at = 0
            for seq, (_, turn, role, text) in enumerate(own):
                kind = "assistant" if role == speaker else "system" if role == "system" else "user"
                name = f" name={role}" if kind == "user" and role is not None else ""
                head = f"<|{kind}{name}|>\n"
                segment = f"{head}{text or ''}<|end|>\n"
                learn = (at + len(head), at + len(segment)) if role == speaker else (None, None)
                found.append((conv, speaker, seq, turn, kind, segment, at, at + len(segment), *learn))
                at += len(segment)
    return sorted(found, key=repr)


ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "anna", "hello"), (1, 2, "bo", "hi ü 🙂"), (1, 3, "carl", None), (1, 4, "anna", "bye"),
    (2, 5, "user", "x"), (2, 5, "user", "x"), (2, None, "assistant", ""), (3, 0, "system", "alone"),
    (None, 1, "user", "no conversation"), (None, 2, "assistant", "none"), (4, 1, None, "nobody"), (4, 2, "user", "someone"), (4, -700, "dan", "early"),
]


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_every_perspective(spark):
    assert rows_of(chat.perspectives(table(spark, ROWS))) == plain(ROWS)


@pytest.mark.parametrize("block", [1, 7])
def test_long_conversation_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows = [(9, i, f"p{i % 3}", f"turn {i}") for i in range(120)] + ROWS
    assert rows_of(chat.perspectives(table(spark, rows))) == plain(rows)


def test_blocks_go_by_rows(spark, monkeypatch):
    """One conversation without number, most turns null or equal: no block has more rows than the bound."""
    monkeypatch.setattr(chat, "BLOCK", 50)
    rows = [(None, None if i % 2 else i % 3, f"p{i % 2}", f"text {i}") for i in range(900)] + ROWS
    assert rows_of(chat.perspectives(table(spark, rows))) == plain(rows)
    blocks = chat._in_blocks(table(spark, rows), ["conv_id", "turn", "role", "text"]).groupBy("block").count().collect()
    assert max(r["count"] for r in blocks) <= 50 and len(blocks) >= 18


def test_segments_are_the_text(spark):
    found = [r for r in chat.perspectives(table(spark, ROWS)).collect() if (r.conv_id, r.participant) == (1, "bo")]
    text = "".join(r.segment for r in sorted(found, key=lambda r: r.seq))
    learnt = [text[r.learn_start : r.learn_end] for r in found if r.learn_start is not None]
    assert learnt == ["hi ü 🙂<|end|>\n"]
    assert "<|user name=anna|>\nhello<|end|>\n" in text and text.startswith("<|system|>\nbe kind")


def test_empty(spark):
    assert chat.perspectives(table(spark, [])).collect() == []
