"""The training order: which sequence gets which slot, whatever the splits; resumable shards."""

import numpy as np
import pytest
import xxhash

from floodplan.llm import binary
from floodplan.llm.queries import RANKS, vocabulary

LENGTH, SHARD = 8, 16
ROWS = [(i % 37, f"text {i} " * (i % 11), "x", i) for i in range(150)]
ROWS += [(None, "no id", "x", 0), (5, None, "x", 0), (6, "", "x", 0), (7, "a " * 700, "x", 0)]
ROWS += [(8, "the same row again", "x", 1)] * 6


@pytest.fixture(scope="module")
def table(spark):
    # Columns of the result's own names, with other contents.
    return spark.createDataFrame(ROWS, "doc_id long, text string, record string, slot int")


def plain():
    """(doc_id, sequence, record) by slot: sequences numbered by id and hash of the text."""
    encode = binary._encoding(vocabulary(RANKS)).encode_ordinary
    signed = lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
    rows = [(d, t) for d, t, *_ in ROWS if t]
    found = []
    for doc, text in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], signed(r[1]))):
        ids = encode(text)
        for n in range(0, len(ids), LENGTH):
            part = ids[n : n + LENGTH] + [binary.PAD] * max(0, n + LENGTH - len(ids))
            found.append((doc, n // LENGTH, np.array(part, np.uint16).tobytes()))
    slots = binary.feistel(np.arange(len(found)), len(found))
    return dict(zip(slots.tolist(), found))


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_slots_depend_on_rows_alone(spark, table, parts, monkeypatch):
    monkeypatch.setattr(binary, "SLICE", 5)  # giant documents go out in several batches
    ordered = binary.training_order(table.repartition(parts), vocabulary(RANKS), LENGTH, SHARD)
    rows = ordered.collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert {r.slot: (r.doc_id, r.sequence, bytes(r.record)) for r in rows} == plain()
    assert all((r.shard, r.place) == divmod(r.slot, SHARD) for r in rows)


def test_reading_goes_on_in_the_middle_of_a_shard(spark, table, tmp_path):
    want = plain()
    ordered = binary.training_order(table, vocabulary(RANKS), LENGTH, SHARD)
    binary.write_shards(ordered, str(tmp_path / "shards"))
    for slot in (0, SHARD + 5, len(want) - 1):
        back = binary.read_from(spark, str(tmp_path / "shards"), slot, LENGTH, SHARD).collect()
        assert {r.slot: bytes(r.record) for r in back} == {s: r for s, (_, _, r) in want.items() if s >= slot}


SPACED = [" ", "  ", "\n", "\n\n", "\t ", "\r\n", "\x0b", "\x1c", "\x1f ", "\x85", "\xa0", "\u1680", "\u2003", "\u2028"]
SPACED += ["\u202f", "\u205f ", "\u200b", "\u3000", "\ufeff ", "\xad", "\u180e", "\x00", "a", "word", "it's", "'ll", "7"]
SPACED += ["\u65e5\u672c", "\xe9", "e\u0301", "\u0663", "!", "...", "\U0001f600", "_"]


def test_ids_are_those_of_the_whole_text():
    encode, tokens = binary._encoding(vocabulary(RANKS)).encode_ordinary, binary.Tokens(vocabulary(RANKS))
    draw = np.random.default_rng(5)
    texts = ["".join(draw.choice(SPACED, draw.integers(1, 12))) for _ in range(4000)]
    texts += [chr(c).join(["a", " b", "c ", "\n", "d", ""]) for c in range(0x3100)]
    for text in texts:
        assert np.frombuffer(tokens.of(text), np.uint16).tolist() == encode(text), repr(text)


def test_words_take_no_call_each():
    tokens, calls = binary.Tokens(vocabulary(RANKS)), []
    encode = tokens.encode
    tokens.encode = lambda part: calls.append(part) or encode(part)
    text = " ".join(f"word{n}" for n in range(1000))
    assert np.frombuffer(tokens.of(text), np.uint16).tolist() == encode(text)
    assert len(calls) == 1
    tokens.of(text + "\n\n" + text)
    assert len(calls) == 3


def test_long_run_of_spaces():
    text = " " * 1_500_000 + "a"
    ids = np.frombuffer(binary.Tokens(vocabulary(RANKS)).of(text), np.uint16)
    assert binary._encoding(vocabulary(RANKS)).decode(ids.tolist()) == text
