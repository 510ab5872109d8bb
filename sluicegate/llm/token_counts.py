"""Token counts of texts of any length, huge ones encoded in overlapping chunks.

A text of up to ``chunk`` characters is encoded whole.  A longer one is cut into chunks that overlap, which are dealt
to tasks and encoded with offsets, each on its own.  Near its ends a chunk's tokens may be wrong, so two
neighbours are spliced at a boundary that both have in their overlap and that is proven stable: a single space
between two ASCII letters, which no token crosses in either encoding.  The tokenizers handled cut words
at such a space before any merge, and no piece of theirs runs over one, so what stands left of it cannot change the
tokens to its right.  The count is the sum over chunks, less what stands beyond each seam on both of its sides: sums
by document, for which no document is gathered again.

Where a seam finds no common stable boundary, its document is cut anew with overlaps eight times as wide, and at last
encoded whole, so texts without any such space are counted too; they are the only ones that take one task each.

Null and empty texts have no bytes and no tokens.  Repeated rows and null ids are counted row by row.  An empty
table gives no rows.  Names of further columns cannot clash, as only the id is kept beside the counts.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.frames import stored
from sluicegate.llm.packing import PartEncoder

CHUNK = 65_536
OVERLAP = 256
WIDER = 8
SEAM = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
SPACE_MARK = "▁"
_ENCODED = T.StructType(
    [
        T.StructField("row", T.StringType()),
        T.StructField("seam", T.LongType()),
        T.StructField("side", T.IntegerType()),
        T.StructField("tokens", T.LongType()),
        T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("beyond", T.ArrayType(T.LongType())),
    ]
)


class JsonTokenizer:
    """A vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        spec = json.loads(self._tokenizer.to_str())
        cuts = json.dumps(spec["pre_tokenizer"])
        # Both known patterns end a run of letters at a space: one drops it, one begins the next word with it.
        if spec["model"]["type"] != "BPE" or "ByteLevel" not in cuts:
            raise ValueError(f"{path}: no proof that its tokens end at a space between letters")
        self._parts = PartEncoder(path) if spec["model"]["end_of_word_suffix"] else None

    def counts(self, texts: list[str]) -> list[int]:
        if self._parts:
            return [len(ids) // 4 for ids in self._parts.encode(texts)]
        encode = self._tokenizer.encode_batch_fast
        return [len(e) for e in encode(texts, add_special_tokens=False)]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every token, in characters."""
        offsets = self._tokenizer.encode(text, add_special_tokens=False).offsets
        return tuple(np.array(offsets, np.int64).reshape(-1, 2).T)


class PieceModel:
    """A vocabulary of the sentencepiece library."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self._model.id_to_piece, range(self._model.get_piece_size()))
        if any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in pieces):
            raise ValueError(f"{path}: has pieces that run over a space")

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self._model.encode(texts, num_threads=1)]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        offsets = self._model.encode(text, return_type="offset_mapping")["offsets"]
        return tuple(np.array(offsets, np.int64).reshape(-1, 2).T)


@functools.lru_cache(maxsize=1)
def tokenizer_at(path: str) -> JsonTokenizer | PieceModel:
    """One tokenizer per worker process."""
    return PieceModel(path) if path.endswith(".model") else JsonTokenizer(path)


def cuts(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Ranges of ``chunk`` characters that overlap by ``overlap``; the whole text if that is no less."""
    if length <= chunk or 2 * overlap >= chunk:
        return [(0, length)]
    step = chunk - overlap
    return [(at, min(at + chunk, length)) for at in range(0, length - overlap, step)]


def seam_sides(known: JsonTokenizer | PieceModel, text: str, overlap: int, first: bool, last: bool):
    """Tokens of a chunk and, for its overlap at each end, the stable places and the tokens beyond them.

    Places count from where the overlap begins.  Beyond the seam lie, on the left side of a chunk,
    the tokens before the place and, on the right side, those from it on.
    """
    begin, end = known.spans(text)
    reach = np.maximum.accumulate(end) if len(end) else end
    sides = []
    for side, low in ((1, 0), (0, len(text) - overlap)):
        if first if side else last:
            continue
        # A place needs the letters beside it inside the overlap.
        places = np.array([m.start() - low for m in SEAM.finditer(text, low, low + overlap) if m.start() > low], np.int64)
        before = np.searchsorted(begin, places + low)
        crossed = reach[before - 1] > places + low if len(reach) else np.zeros(len(places), bool)
        fine = (before == 0) | ~crossed
        beyond = before if side else len(begin) - before
        sides.append((side, places[fine], beyond[fine]))
    return len(begin), sides


def _encode(texts: DataFrame, tokenizer: str, chunk: int, overlap: int) -> DataFrame:
    """Chunks of the texts, dealt to tasks and encoded; a row a chunk and one for each end that has a seam."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ranges = cuts(len(text), chunk, overlap)
                for at, (low, high) in enumerate(ranges):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row]), pa.array([at], pa.int64()), pa.array([at + 1 == len(ranges)]), pa.array([text[low:high]])],
                        ["row", "at", "last", "text"],
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer_at(tokenizer)
        for batch in batches:
            out = []
            for row, at, last, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens, sides = seam_sides(known, text, overlap, at == 0, last)
                out.append((row, None, None, tokens, None, None))
                # Seam n lies between the chunks n and n + 1.
                out += [(row, at - side, side, None, p.tolist(), b.tolist()) for side, p, b in sides]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = zip(*out, strict=True) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], _ENCODED.names
            )

    pieces = texts.mapInArrow(cut, "row string, at long, last boolean, text string")
    # Equal texts share a name, so their chunks meet before and in the shuffle that deals them out.
    dealt = pieces.groupBy("row", "at").agg(F.first("last").alias("last"), F.first("text").alias("text"))
    return dealt.mapInArrow(encode, _ENCODED)


def _spliced(encoded: DataFrame) -> DataFrame:
    """Tokens of each text; null where a seam has no common stable boundary."""
    one = [F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}{s}") for s in (0, 1) for c in ("places", "beyond")]
    seams = encoded.where("seam is not null").groupBy("row", "seam").agg(*one)
    common = F.array_min(F.array_intersect("places0", "places1"))
    held = [F.element_at(f"beyond{s}", F.array_position(f"places{s}", common).cast("int")) for s in (0, 1)]
    waste = seams.select("row", (-(held[0] + held[1])).alias("tokens"))
    parts = encoded.where("seam is null").select("row", "tokens").unionAll(waste)
    lost = F.count_if(F.col("tokens").isNull())
    return parts.groupBy("row").agg(F.when(lost == 0, F.sum("tokens")).alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    *,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Bytes and tokens of every text, as the tokenizer's library gives them without added tokens."""
    if not 0 < 2 * overlap < chunk:
        raise ValueError("an overlap must be less than half a chunk")
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    named = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    short = F.length("text") <= chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer_at(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(text.encode()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(known.counts(texts), pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)])
    counted = named.where(short).mapInArrow(run, schema.add("n_bytes", "long").add("n_tokens", "long"))
    huge = named.where(~short).withColumn("row", F.md5(F.col("text").cast("binary")))
    left, rounds = huge.select("row", "text"), []
    while not left.isEmpty():
        encoded = stored(_encode(left, tokenizer, chunk, overlap), "token-chunks")
        done = stored(_spliced(encoded), "token-splices")
        rounds.append(done.where("n_tokens is not null"))
        missed = done.where("n_tokens is null").select("row")
        if missed.isEmpty():
            break
        left = huge.select("row", "text").join(missed, "row", "left_semi")
        overlap *= WIDER
    if rounds:
        spliced = functools.reduce(DataFrame.unionAll, rounds)
        sizes = huge.select("id", "row", F.octet_length("text").cast("long").alias("n_bytes"))
        counted = counted.unionByName(sizes.join(spliced, "row").select("id", "n_bytes", "n_tokens"))
    return counted.withColumnRenamed("id", id_column)
