"""SentencePiece encoding and decoding by the best-scoring segmentation, in parallel.

Scores add along a segmentation and the best is kept: max-plus algebra. A giant text is cut
into chunks. A chunk's state at its start is how far the last piece of the chunk before it
reaches in; its matrix holds the best score from each such state to each at its end. Runs of
matrices are multiplied on their own and the products scanned, which gives every chunk the
best score of each of its states; then every chunk is traced back on its own.

Of equal segmentations that with the longest last piece is taken, then that with the longest
before it, and so on. Scores of the model are whole numbers, so they add exactly, and where a
text is cut never shows in its pieces.

Where no piece can cross, as before the space between two words or where two neighbours
are in no piece, what lies between is segmented alone, and words that are not remembered
many at a time.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType

from floodplan.session import settle

#: Code points in a chunk; shorter texts are one chunk.
CHUNK = 32_768
#: Chunks whose matrices are multiplied in one task.
SPAN = 64
#: Words whose segmentation a process remembers.
REMEMBERED = 400_000
#: Longer words are segmented one by one.
LONG = 64
SPACE, LITERAL = "▁", "\ud800"  # a surrogate stands for a text's own U+2581
LOWEST = -np.inf


class Pieces:
    """A model's pieces and scores, as plain values that can be sent to tasks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.key = xxhash.xxh3_128_hexdigest(model.serialized_model_proto())
        ids = range(model.get_piece_size())
        self.text = [model.id_to_piece(i) for i in ids]
        self.byte = {int(self.text[i][3:-1], 16): i for i in ids if model.is_byte(i)}
        plain = [
            i
            for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.score = {self.text[i]: (model.get_score(i), i) for i in plain}
        #: A character without a piece costs more than any piece; it becomes its bytes.
        self.unknown = min(s for s, _ in self.score.values() if s > -1e8) - 10.0
        self.longest = max(map(len, self.score))
        #: Every beginning of a piece: its score and id, or a score that never wins.
        self.prefix = {p[:k]: (LOWEST, -1) for p in self.score for k in range(1, len(p))} | self.score
        #: Neighbours inside some piece; between any others no piece goes across.
        self.joined = {p[k : k + 2] for p in self.score for k in range(len(p) - 1)}
        self.splits = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.joined)
        self.part = self._parts()
        #: The beginnings as a tree: keys of (parent, next character), sorted, and their children.
        number = {p: k + 1 for k, p in enumerate(self.prefix)} | {"": 0}
        steps = sorted((number[p[:-1]] << 21 | ord(p[-1]), number[p]) for p in self.prefix)
        self.step, self.child = (np.array(x, np.int64) for x in zip(*steps))
        found = [(0.0, -1), *self.prefix.values()]
        self.value, self.id = np.array([v for v, _ in found]), np.array([i for _, i in found], np.int32)
        self.decoded = [b""] * len(self.text)
        for piece, (_, i) in self.score.items():
            self.decoded[i] = piece.replace(SPACE, " ").encode()
        for value, i in self.byte.items():
            self.decoded[i] = bytes([value])


    def _parts(self) -> re.Pattern:
        """What matches parts of a marked text, between which no piece crosses.

        Space marks go with what follows, letters apart from other characters if the model
        lets them; a character that it joins with the other kind counts as that kind.
        """
        letter, odd = re.compile(r"[^\W\d_]").match, set()

        def mixed() -> list[tuple[str, str]]:
            kind = {c: bool(letter(c)) and c not in odd for pair in self.joined for c in pair}
            return [(a, b) for a, b in self.joined if a != SPACE and kind[a] != kind[b]]

        odd |= {c for pair in mixed() for c in pair if letter(c)}
        if mixed() or len(odd) > 100:
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        odd_class = "".join(map(re.escape, sorted(odd)))
        return re.compile(f"{SPACE}*(?:[^\\W\\d_{odd_class}]+|(?:[^\\w{SPACE}]|[\\d_{odd_class}])+)|{SPACE}+")


def best_paths(
    pieces: Pieces, text: str, start: int, stop: int, ways: np.ndarray | None = None
) -> tuple[list[float], list[tuple]]:
    """Best score of every place from ``start`` on, and the last piece on the way there.

    Pieces begin before ``stop`` and may end after it. Ties go to the longer piece. With
    ``ways``, these are the scores of the first places by pieces that begin before ``start``.
    """
    end = len(text)
    score, back = [LOWEST] * (end + 1), [()] * (end + 1)
    score[start] = 0.0
    if ways is not None:
        some = min(len(ways), end + 1 - start)
        score[start : start + some] = ways[:some].tolist()
    known, unknown = pieces.prefix.get, (pieces.unknown, -1)
    for i in range(start, min(stop, end)):
        here = score[i]
        if here == LOWEST:
            continue
        j = i + 1
        found = known(text[i:j]) or unknown
        if found[1] < 0:
            if here + unknown[0] > score[j]:
                score[j], back[j] = here + unknown[0], (i, -1)
            if found is unknown:
                continue
        elif here + found[0] > score[j]:
            score[j], back[j] = here + found[0], (i, found[1])
        while j < end:
            j += 1
            found = known(text[i:j])
            if found is None:
                break
            value = here + found[0]
            if value > score[j]:
                score[j], back[j] = value, (i, found[1])
    return score, back


def traced(pieces: Pieces, text: str, back: list[tuple], start: int, end: int) -> list[int]:
    """The pieces of the best path from ``start`` to ``end``."""
    ids: list[int] = []
    while end > start:
        begin, piece = back[end]
        if piece >= 0:
            ids.append(piece)
        else:
            char = SPACE if text[begin] == LITERAL else text[begin]
            ids.extend(pieces.byte[b] for b in reversed(char.encode("utf-8", "surrogatepass")))
        end = begin
    return ids[::-1]


def entered(back: list[tuple], end: int) -> int:
    """Where the best path to ``end`` comes in."""
    while back[end]:
        end = back[end][0]
    return end


def _edges(pieces: Pieces, words: list[str]) -> tuple[np.ndarray, ...]:
    """All pieces in all words: place in their word where they end, first and last node, score, id.

    A word of n characters has n + 1 nodes, and a character that is no piece an edge of id -1.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), lengths)
    begin = np.cumsum(lengths) - lengths
    stop = np.repeat(begin + lengths, lengths)
    at, node, found = np.arange(len(codes)), np.zeros(len(codes), np.int64), []
    for k in range(pieces.longest):
        inside = at + k < stop[at]
        at, node = at[inside], node[inside]
        key = node << 21 | codes[at + k]
        place = np.minimum(np.searchsorted(pieces.step, key), len(pieces.step) - 1)
        known = pieces.step[place] == key
        if not k:
            alone = ~known | (pieces.id[pieces.child[place]] < 0)
            found.append((at[alone], 1, np.full(alone.sum(), pieces.unknown), np.full(alone.sum(), -1, np.int32)))
        at, node = at[known], pieces.child[place[known]]
        whole = pieces.id[node] >= 0
        found.append((at[whole], k + 1, pieces.value[node[whole]], pieces.id[node[whole]]))
    start = np.concatenate([f[0] for f in found])
    end = np.concatenate([f[0] + f[1] for f in found])
    score, piece = (np.concatenate([f[c] for f in found]) for c in (2, 3))
    order = np.lexsort((start, end, end - begin[word[start]]))
    start, end, score, piece = start[order], end[order], score[order], piece[order]
    return end - begin[word[start]], start + word[start], end + word[start], score, piece


def segmented(pieces: Pieces, words: list[str]) -> list[bytes]:
    """Pieces of many words at once, as ``best_paths`` and ``traced`` give them for each."""
    offset, first, last, score, piece = _edges(pieces, words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(lengths + 1) - lengths - 1
    best, back = np.zeros(begin[-1] + lengths[-1] + 1), np.zeros(begin[-1] + lengths[-1] + 1, np.int64)
    cuts = np.searchsorted(offset, np.arange(1, lengths.max() + 2))
    for low, high in zip(cuts, cuts[1:]):
        value, ends = best[first[low:high]] + score[low:high], last[low:high]
        new = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
        top = np.maximum.reduceat(value, new)
        group = np.repeat(np.arange(len(new)), np.diff(np.r_[new, high - low]))
        equal = np.flatnonzero(value == top[group])
        # The first edge of equal value begins first.
        chosen = equal[np.r_[True, group[equal][1:] != group[equal][:-1]]]
        best[ends[new]], back[ends[new]] = top, chosen + low
    here, word, steps = begin + lengths, np.arange(len(words)), []
    while len(here):
        edge = back[here]
        steps.append((word, piece[edge]))
        here = first[edge]
        more = here > begin[word]
        here, word = here[more], word[more]
    owner = np.concatenate([w for w, _ in steps[::-1]])
    ids = np.concatenate([i for _, i in steps[::-1]])
    order = np.argsort(owner, kind="stable")
    ids, ends = ids[order], np.cumsum(np.bincount(owner, minlength=len(words)))
    whole, odd = ids.tobytes(), set(owner[order][ids < 0].tolist())
    found = []
    for k, (a, b) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
        found.append(_alone(pieces, words[k]) if k in odd else whole[4 * a : 4 * b])
    return found


def _alone(pieces: Pieces, word: str) -> bytes:
    """One word, where no piece crosses each part of it on its own."""
    cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in pieces.joined]
    ids = array("i")
    for a, b in zip([0, *cuts], [*cuts, len(word)]):
        part = word[a:b]
        ids.extend(traced(pieces, part, best_paths(pieces, part, 0, b - a)[1], 0, b - a))
    return ids.tobytes()


class Words(dict):
    """Pieces of words as bytes of 32-bit numbers, each word segmented once."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def learn(self, words: Iterable[str]) -> None:
        """Segment those of the words that are not known, together."""
        new = {w for w in words if w not in self and len(w) <= LONG}
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = {w for w in words if len(w) <= LONG}
        if new:
            self.update(zip(new, segmented(self.pieces, list(new))))

    def __missing__(self, word: str) -> bytes:
        return _alone(self.pieces, word)


_WORDS: dict[str, Words] = {}


def remembered(model) -> Words:
    """The words that this process has segmented with a model, for one task after another."""
    pieces = model.value
    words = _WORDS.get(pieces.key)
    if words is None:
        _WORDS.clear()
        words = _WORDS[pieces.key] = Words(pieces)
    return words


def marked(text: str, first: bool) -> str:
    text = text.replace(SPACE, LITERAL).replace(" ", SPACE)
    return SPACE + text if first else text


def split_words(pieces: Pieces, text: str) -> list[str]:
    """A marked text cut where no piece crosses."""
    if not pieces.splits:
        return [text] if text else []
    return pieces.part.findall(text)


def encode_texts(words: Words, texts: list[str]) -> list[np.ndarray]:
    """Pieces of marked texts, each empty or beginning with a space mark."""
    parts = [split_words(words.pieces, text) for text in texts]
    words.learn(set().union(*parts))
    return [np.frombuffer(b"".join(map(words.__getitem__, p)), np.int32) for p in parts]


class Chunk:
    """A chunk of a giant text: ``text`` goes on beyond its ``size`` as far as a piece may."""

    def __init__(self, pieces: Pieces, raw: str, size: int, first: bool):
        self.pieces, self.first = pieces, first
        self.text = marked(raw, first)
        self.size = size + first
        places = [
            i
            for i in range(1, self.size)
            if self.text[i] == SPACE and self.text[i - 1] != SPACE
        ] if pieces.splits else []
        self.cuts = (places[0], places[-1]) if places else None

    def matrix(self) -> np.ndarray:
        """Best score from each entry (row) to each exit (column), less what all share."""
        n, states = self.size, self.pieces.longest
        found = np.full((states, states), LOWEST)
        reach = min(states, len(self.text) - n + 1)
        if self.cuts:
            head, tail = self.cuts
            leave = best_paths(self.pieces, self.text, tail, n)[0]
            for i in range(min(states, head + 1)):
                enter = best_paths(self.pieces, self.text[:head], i, head)[0][head]
                found[i, :reach] = enter + np.array(leave[n : n + reach])
        else:
            for i in range(min(states, n + 1)):
                found[i, :reach] = best_paths(self.pieces, self.text, i, n)[0][n : n + reach]
        return found

    def entries(self, ways: np.ndarray) -> list[int]:
        """Where the best path to each exit enters, if the entries have scores ``ways``."""
        states, n = self.pieces.longest, self.size
        if self.cuts:
            head = self.cuts[0]
            back = best_paths(self.pieces, self.text[:head], 0, head, ways)[1]
            return [entered(back, head)] * states
        back = best_paths(self.pieces, self.text, 0, n, ways)[1]
        return [entered(back, min(n + r, len(self.text))) for r in range(states)]

    def ids(self, words: Words, entry: int, leave: int) -> np.ndarray:
        parts, end = [], self.size + leave
        head, tail = self.cuts or (entry, entry)
        if self.cuts:
            piece = self.text[entry:head]
            back = best_paths(self.pieces, piece, 0, len(piece))[1]
            parts.append(np.array(traced(self.pieces, piece, back, 0, len(piece)), np.int32))
            parts.extend(encode_texts(words, [self.text[head:tail]]))
        back = best_paths(self.pieces, self.text[:end], tail, self.size)[1]
        parts.append(np.array(traced(self.pieces, self.text, back, tail, end), np.int32))
        return np.concatenate(parts)


def product(matrices: list[np.ndarray]) -> np.ndarray:
    """Best scores through several chunks, less what all share."""
    whole = matrices[0]
    for m in matrices[1:]:
        whole = (whole[:, :, None] + m[None]).max(axis=1)
        whole = whole - whole.max()
    return whole


def scan(ways: np.ndarray, matrices: list[np.ndarray]) -> list[np.ndarray]:
    """The scores of the entries of every chunk, beginning with ``ways``."""
    found = [ways]
    for m in matrices[:-1]:
        found.append((found[-1][:, None] + m).max(axis=0))
        found[-1] = found[-1] - found[-1].max()  # only differences matter
    return found


def passed(entries: list) -> list[tuple[int, int]]:
    """Entry and exit of every chunk, from the entry that each exit has; the last exit is 0."""
    found, leave = [], 0
    for of in reversed(entries):
        found.append((int(of[leave]), leave))
        leave = found[-1][0]
    return found[::-1]


def load(spark: SparkSession, path: str):
    """The model read once and sent to tasks; its size is that of its vocabulary."""
    return spark.sparkContext.broadcast(Pieces(path))


def _encoder(model):
    @pandas_udf(ArrayType(IntegerType()))
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = remembered(model)
        for text in texts:
            ids = encode_texts(words, [marked(t, bool(t)) if t else "" for t in text])
            found = [None if t is None else i for t, i in zip(text, ids)]
            yield pd.Series(found, index=text.index, dtype=object)

    return encode


def decoder(model):
    """A column function: pieces back to text."""

    @pandas_udf(StringType())
    def decode(ids: pd.Series) -> pd.Series:
        table = model.value.decoded
        return pd.Series(
            [
                None if i is None else b"".join(map(table.__getitem__, i.tolist()))[1:].decode()
                for i in ids
            ],
            index=ids.index,
            dtype=object,
        )

    return decode


def encoded(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """(row, ids): each row of ``docs`` as a struct, and the pieces of its text.

    A null text has null, an empty one no pieces. Any text decodes to itself: characters
    without a piece become their bytes, and a space mark in the text does too.
    """
    spark = docs.sparkSession
    model = load(spark, path)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("text").alias("text"))
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = rows.filter(~giant).select("row", _encoder(model)("text").alias("ids"))
    long = settle(rows.filter(giant).select("row", "text", F.monotonically_increasing_id().alias("rid")))
    pieces = _giant_ids(long.select("rid", "text"), model, chunk)
    return short.union(long.select("row", "rid").join(pieces, "rid", "left").select("row", "ids"))


def _giant_ids(texts: DataFrame, model, chunk: int) -> DataFrame:
    """(rid, ids) of the giant texts (rid, text)."""
    ahead = model.value.longest - 1
    number = F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk).cast("int")))
    cut = F.substring("text", F.col("number") * chunk + 1, F.lit(chunk + ahead))
    chunks = settle(
        texts.select("rid", "text", number.alias("number"))
        .repartition("rid", "number")
        .select("rid", "number", cut.alias("raw"))
    )

    side = model.value.longest

    def square(m) -> np.ndarray:
        return np.asarray(m).reshape(side, side)

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                Chunk(model.value, raw, min(chunk, len(raw)), number == 0).matrix().ravel()
                for raw, number in zip(batch["raw"], batch["number"])
            ]
            yield pd.DataFrame({"rid": batch["rid"], "number": batch["number"], "matrix": found})

    def multiplied(group: pd.DataFrame) -> pd.DataFrame:
        """The product of a run of chunks."""
        whole = product([square(m) for m in group.sort_values("number")["matrix"]])
        return pd.DataFrame({"rid": group["rid"][:1], "run": group["run"][:1], "matrix": [whole.ravel()]})

    def runs(group: pd.DataFrame) -> pd.DataFrame:
        """The scores with which each run of a text begins."""
        group = group.sort_values("run")
        start = np.full(side, LOWEST)
        start[0] = 0.0
        found = scan(start, [square(m) for m in group["matrix"]])
        return pd.DataFrame({"rid": group["rid"], "run": group["run"], "start": found})

    def ways(group: pd.DataFrame) -> pd.DataFrame:
        """The scores with which each chunk of a run begins."""
        group = group.sort_values("number")
        found = scan(np.asarray(group["start"].iloc[0]), [square(m) for m in group["matrix"]])
        return pd.DataFrame({"rid": group["rid"], "number": group["number"], "ways": found})

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                Chunk(model.value, r.raw, min(chunk, len(r.raw)), r.number == 0).entries(r.ways)
                for r in batch.itertuples()
            ]
            yield pd.DataFrame({"rid": batch["rid"], "number": batch["number"], "entries": found})

    def states(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("number")
        found = passed(group["entries"].tolist())
        return pd.DataFrame(
            {
                "rid": group["rid"],
                "number": group["number"],
                "entry": [a for a, _ in found],
                "leave": [b for _, b in found],
            }
        )

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = remembered(model)
        for batch in batches:
            found = [
                Chunk(model.value, r.raw, min(chunk, len(r.raw)), r.number == 0).ids(words, r.entry, r.leave)
                for r in batch.itertuples()
            ]
            yield pd.DataFrame({"rid": batch["rid"], "number": batch["number"], "ids": found})

    run = F.floor(F.col("number") / SPAN).cast("int").alias("run")
    each = settle(chunks.mapInPandas(matrices, "rid long, number int, matrix array<double>").select("*", run))
    begun = (
        each.groupBy("rid", "run")
        .applyInPandas(multiplied, "rid long, run int, matrix array<double>")
        .groupBy("rid")
        .applyInPandas(runs, "rid long, run int, start array<double>")
    )
    entering = (
        each.join(begun, ["rid", "run"])
        .groupBy("rid", "run")
        .applyInPandas(ways, "rid long, number int, ways array<double>")
    )
    placed = (
        chunks.join(entering, ["rid", "number"])
        .mapInPandas(entries, "rid long, number int, entries array<int>")
        .groupBy("rid")
        .applyInPandas(states, "rid long, number int, entry int, leave int")
    )
    return (
        chunks.join(placed, ["rid", "number"])
        .mapInPandas(trace, "rid long, number int, ids array<int>")
        .groupBy("rid")
        .agg(F.array_sort(F.collect_list(F.struct("number", "ids"))).alias("parts"))
        .select("rid", F.flatten("parts.ids").alias("ids"))
    )


def encode_documents(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with their pieces in ``ids``, their number and whether they decode exactly.

    Columns doc_id, n_tokens, ids, exact; a row for each row. A null text gives nulls.
    """
    found = encoded(docs.select("doc_id", "text"), path, chunk)
    decode = decoder(load(docs.sparkSession, path))
    return found.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (decode("ids") == F.col("row.text")).alias("exact"),
    ).withColumn("n_tokens", F.when(F.col("ids").isNotNull(), F.col("n_tokens")))


def digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256)
