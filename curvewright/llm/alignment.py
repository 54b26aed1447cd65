"""Operator 13: which tokens of two tokenizers stand for the same bytes, and how often corpus-wide."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from curvewright.llm.bpe import AGREED, byte_letters, read
from curvewright.llm.common import bounded, query, stored, table

#: Public vocabularies of both sides; the paths are parameters.
BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: UTF-8 bytes of texts that are aligned as one chunk, and that are encoded by one call.
CHUNK, CALL = 1 << 19, 1 << 18
#: How byte-level tokenizers of this kind split a text before they merge; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ADDED = (
    "__batch long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "__a array<int>, __b array<int>, __m array<long>, __summary boolean"
)


class Tokenizers:
    """Both tokenizers, and for each the bytes of every token."""

    def __init__(self, first: str, second: bytes):
        self._file, self._library = first, None
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        named = {i: bytes(byte_of[c] for c in t) for t, i in json.loads(first)["model"]["vocab"].items()}
        # The file's merges make ids in order, so an id is also its merge's rank.
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks={t: i for i, t in named.items()}, special_tokens={}
        )
        self.a_bytes = pa.array([named.get(i) for i in range(max(named) + 1)], pa.binary())
        pieces = range(self.b.get_piece_size())
        self.b_bytes = pa.array([self._piece(i) for i in pieces], pa.binary())

    @property
    def library(self) -> Tokenizer:
        """The file's own tokenizer, loaded when a text first needs it."""
        if self._library is None:
            self._library = Tokenizer.from_str(self._file)
            self._library.encode_special_tokens = True  # their strings in a text are ordinary text
        return self._library

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        """Ids under the file's tokenizer; by ranks, which is faster, where both split alike."""
        if text.isascii() or AGREED.fullmatch(text):
            return self.ranks.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        kind = pa.list_(pa.int32())
        a = pa.array([self.encode_a(" " + t) for t in texts], kind)
        return a, pa.array(self.b.encode(texts, num_threads=1), kind)


@lru_cache(maxsize=1)
def tokenizers(first: str, second: bytes) -> Tokenizers:
    """One pair a process."""
    return Tokenizers(first, second)


def _ends(owners: np.ndarray, n: int) -> pa.Array:
    """Offsets of a list array whose items belong to ``owners`` (ascending)."""
    return pa.array(np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))]), pa.int32())


def _lists(owners: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(_ends(owners, n), values)


def _spelled(ids: pa.ListArray, names: pa.Array, wanted: pa.Array) -> np.ndarray:
    """Whether each row's joined token bytes are the wanted ones."""
    joined = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, names.take(ids.values)), b"")
    return pc.equal(joined, wanted).to_numpy(zero_copy_only=False)


def _tokens(ids: pa.ListArray, names: pa.Array) -> pa.Table:
    """One row per token: its document, id and the byte of the chunk where it ends."""
    flat = pc.list_flatten(ids)
    end = pc.cumulative_sum(pc.binary_length(names.take(flat)).cast(pa.int64()))
    return pa.table({"doc": pc.list_parent_indices(ids).cast(pa.int64()), "id": flat, "end": end})


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two ascending arrays without repeats hold the same values."""
    at = np.searchsorted(b, a)
    same = np.flatnonzero(b[np.minimum(at, len(b) - 1)] == a) if len(b) else np.zeros(0, np.int64)
    return same, at[same]


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of the weights of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights[order], first) if len(keys) else np.zeros(0, np.int64)


def _counted(side: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and number of the distinct ids of each group, by group."""
    keys, times = np.unique(side["group"].to_numpy() << 32 | side["id"].to_numpy(), return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, times


def _groups(tokens: pa.Table, cuts: np.ndarray) -> np.ndarray:
    """The group of each token: how many cuts lie before it. Each document ends with one."""
    is_cut = np.zeros(len(tokens), np.int64)
    is_cut[cuts] = 1
    return np.cumsum(is_cut) - is_cut


def align_texts(both: Tokenizers, texts: list[str]) -> tuple[dict[str, pa.Array], pa.Table]:
    """Columns of one chunk of texts, and its id pairs with the number of texts that link them."""
    encoded = []
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CALL or i == len(texts) - 1:
            encoded.append(both.encode(texts[at : i + 1]))
            at, size = i + 1, 0
    kind = pa.list_(pa.int32())
    a = pa.concat_arrays([x for x, _ in encoded] or [pa.array([], kind)])
    b = pa.concat_arrays([y for _, y in encoded] or [pa.array([], kind)])
    n = len(texts)
    wanted = pa.array([b" " + t.encode() for t in texts], pa.binary())
    good = _spelled(a, both.a_bytes, wanted) & _spelled(b, both.b_bytes, wanted)
    good &= np.fromiter((t != "" for t in texts), bool, n)
    none = pa.scalar([], kind)
    a, b = (pc.if_else(pa.array(good), ids, none) for ids in (a, b))
    left, right = _tokens(a, both.a_bytes), _tokens(b, both.b_bytes)

    # Kept texts have the same bytes on both sides, so ends count on through the chunk and
    # rise on both: where a token of each ends is a cut.
    ends, others = left["end"].to_numpy(), right["end"].to_numpy()
    left_cuts, right_cuts = _common(ends, others)
    left = left.append_column("group", pa.array(_groups(left, left_cuts)))
    right = right.append_column("group", pa.array(_groups(right, right_cuts)))
    n_all = len(left_cuts)
    group_doc = np.zeros(n_all, np.int64)
    group_doc[left["group"].to_numpy()] = left["doc"].to_numpy()
    sizes = [np.bincount(side["group"].to_numpy(), minlength=n_all) for side in (left, right)]

    def spelled_groups(side):
        ids = side["id"].cast(pa.string()).combine_chunks()
        return pc.binary_join(_lists(side["group"].to_numpy(), n_all, ids), ",")

    text = pc.binary_join_element_wise(spelled_groups(left), spelled_groups(right), "|")
    columns = {
        "n_a": pc.list_value_length(a).cast(pa.int64()),
        "n_b": pc.list_value_length(b).cast(pa.int64()),
        "n_groups": pa.array(np.bincount(group_doc, minlength=n)),
        "n_links": pa.array(np.bincount(group_doc, weights=sizes[0] * sizes[1], minlength=n).astype(np.int64)),
        "groups": pc.binary_join(_lists(group_doc, n, text), ";"),
    }

    # Links with their multiplicities: equal tokens of a group are counted before they meet.
    (a_group, a_id, a_m), (b_group, b_id, b_m) = (_counted(side) for side in (left, right))
    first = np.searchsorted(b_group, a_group)
    partners = np.searchsorted(b_group, a_group, side="right") - first
    at = np.repeat(np.arange(len(a_group)), partners)
    to = np.arange(len(at)) - np.repeat(np.cumsum(partners) - partners, partners) + first[at]
    wide, ids = len(both.a_bytes) * len(both.b_bytes), a_id[at] * len(both.b_bytes) + b_id[to]
    links, times = _summed(group_doc[a_group[at]] * wide + ids, a_m[at] * b_m[to])
    owner, ids = links // wide, links % wide
    for name, values in (("__a", ids // len(both.b_bytes)), ("__b", ids % len(both.b_bytes)), ("__m", times)):
        columns[name] = _lists(owner, n, pa.array(values, pa.int64() if name == "__m" else pa.int32()))
    ids, texts_with = np.unique(ids, return_counts=True)
    pairs = pa.table({
        "a": pa.array(ids // len(both.b_bytes), pa.int32()),
        "b": pa.array(ids % len(both.b_bytes), pa.int32()),
        "count_all": pa.array(texts_with, pa.int64()),
    })
    return columns, pairs


def align(docs: DataFrame, first: str = BYTE_BPE, second: str = PIECE_BPE) -> DataFrame:
    """The alignment of every row of ``docs`` (doc_id, text), and one summary row per chunk.

    ``groups`` spells a text's groups in order, ``a1,a2|b1;a3|b2,b3``; n_a, n_b,
    n_groups and n_links count tokens, groups and linked token occurrences; __a,
    __b and __m list the distinct linked id pairs and their occurrences. A
    summary row (``__summary``) lists the pairs of its chunk (``__batch``) and in
    how many of its rows each is linked. Null and empty texts, and those whose
    tokens of either side do not spell space and text, have no tokens: zeros, an
    empty ``groups``. Whole texts are read, CHUNK bytes (at least one text) at a
    time; a group's equal tokens are combined, so a long run that never aligns
    costs its distinct id pairs. Repeated rows are rows of their own; an empty
    table gives an empty result; other columns are not read. Rows stay where
    they are; only the two vocabulary files are broadcast.
    """
    context = docs.sparkSession.sparkContext
    with open(second, "rb") as file:
        files = context.broadcast((read(first), file.read()))
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(_ADDED).fields])
    names = schema.names

    def run(batches):
        both, part, chunk = tokenizers(*files.value), TaskContext.get().partitionId(), 0

        def rows(ids: pa.Array, texts: list[str]):
            nonlocal chunk
            columns, pairs = align_texts(both, texts)
            n, own = len(texts), (part << 32) | chunk
            chunk += 1
            columns |= {"doc_id": ids, "__batch": pa.array(np.full(n, own)), "__summary": pa.array(np.zeros(n, bool))}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)
            one = {c: pa.nulls(1, t) for c, t in zip(names, (columns[c].type for c in names), strict=True)}
            one |= {"__batch": pa.array([own]), "__summary": pa.array([True])}
            for name, source in (("__a", "a"), ("__b", "b"), ("__m", "count_all")):
                one[name] = _lists(np.zeros(len(pairs), np.int64), 1, pairs[source].combine_chunks())
            yield pa.RecordBatch.from_arrays([one[c] for c in names], names=names)

        for batch in batches:
            ids, texts, at, size = batch.column(0), [], 0, 0
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK or i == batch.num_rows - 1:
                    yield from rows(ids.slice(at, len(texts)), texts)
                    texts, at, size = [], i + 1, 0

    return bounded(docs.select("doc_id", F.col("text").alias("__text"))).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, count, best) of every id pair linked in a row: in how many rows, and whether no pair of ``a`` has more.

    The chunks' partial counts are added up; an id has at most as many partners
    as the other vocabulary has tokens, so the window over one is bounded.
    """
    counts = partial_counts(aligned).groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy("a"))
    return counts.withColumn("best", F.col("count") == most)


def partial_counts(aligned: DataFrame) -> DataFrame:
    """(__batch, a, b, n): the summary rows of ``align``, one row per pair."""
    pair = F.explode(F.arrays_zip("__a", "__b", "__m")).alias("p")
    return aligned.where("__summary").select("__batch", pair).select(
        "__batch", F.col("p.__a").alias("a"), F.col("p.__b").alias("b"), F.col("p.__m").alias("n")
    )


def with_counts(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` with ``n_best`` and ``count_sum`` instead of their link lists.

    Links never move one by one: a pair's corpus-wide count is sent once to each
    chunk that links it, and meets that chunk's rows there. A pair that most
    texts hold is thus as many rows as there are chunks.
    """
    aligned = stored(aligned, "alignment")
    counts = pair_counts(aligned)
    priced = partial_counts(aligned).drop("n").join(counts, ["a", "b"])
    priced = priced.select(F.col("__batch").alias("__at"), "a", "b", "count", "best")
    rows = aligned.where("not __summary").drop("__summary")
    kept = [c for c in rows.columns if c not in ("__batch", "__a", "__b", "__m")]
    schema = T.StructType([rows.schema[c] for c in kept] + T.StructType.fromDDL("n_best long, count_sum long").fields)

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = {c: left[c].combine_chunks() for c in ("__a", "__b", "__m")}
        links = pa.table({
            "row": pc.list_parent_indices(lists["__a"]).cast(pa.int64()),
            "a": pc.list_flatten(lists["__a"]),
            "b": pc.list_flatten(lists["__b"]),
            "m": pc.list_flatten(lists["__m"]),
        })
        met = links.join(right.select(["a", "b", "count", "best"]), ["a", "b"], join_type="inner", use_threads=False)
        per_row = pa.table({
            "row": met["row"],
            "n_best": pc.multiply(met["m"], met["best"].cast(pa.int64())),
            "count_sum": pc.multiply(met["m"], met["count"]),
        }).group_by("row", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
        made = left.select(kept)
        for name in ("n_best", "count_sum"):
            sums = np.zeros(len(left), np.int64)
            sums[per_row["row"].to_numpy()] = per_row[f"{name}_sum"].to_numpy()
            made = made.append_column(name, pa.array(sums))
        return made

    return rows.groupBy("__batch").cogroup(priced.groupBy("__at")).applyInArrow(look_up, schema)


def spelled(groups: Column) -> Column:
    """The digest of a text's groups; an empty text where it has none."""
    return F.when(groups == "", "").otherwise(F.sha2(groups, 256))


@query("op13_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: token counts of both sides, groups, links and what the corpus says of them."""
    aligned = align(table(spark, sf_dir, "documents"))
    hashed = aligned.withColumn("groups_sha256", spelled(F.col("groups"))).drop("groups")
    rows = with_counts(hashed)
    return rows.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
