"""Operator 11: byte-pair encoding and decoding over a lexicon of frequent words."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curvewright.llm.common import bounded, query, raw_bytes, stored, table, text_map
from curvewright.llm.transducer import Transducer, compile_words
from curvewright.session import shared_dir

#: A public vocabulary with word ends; the path is a parameter.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: Words of the lexicon, the most frequent ones, and the longest of them in bytes.
LEXICON, LONGEST = 65_536, 64
#: Words that a task encodes at once, and unseen ones whose merges it remembers.
AT_ONCE, REMEMBERED = 200_000, 200_000
#: Bytes up to which a word's pairs are scanned for each merge, and the rank of a pair without one.
SHORT, NO_MERGE = 48, 1 << 60

#: Characters on which this module's Unicode tables and the tokenizer library's agree
#: (Latin, Greek, Cyrillic, punctuation, signs, kana, common Han, Hangul, emoji);
#: a text with any other is normalised and split by the library.
AGREED = regex.compile(
    "[\0-ԯḀ-ỿ -⁤₠-₿℀-↋←-⏿ぁ-ゖ゙-ヿ"
    "一-鿼가-힣\U0001f300-\U0001f64f]*+"
)
#: The shape of a vocabulary file that this module can read.
_NORMALISERS = ["NFC", "Replace", "Lowercase"]


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if visible, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class Encoder:
    """Splits texts into words as the vocabulary file says and merges single words."""

    def __init__(self, file: str):
        made = json.loads(file)
        model, shape = made["model"], made["pre_tokenizer"]["pretokenizers"]
        if [n["type"] for n in made["normalizer"]["normalizers"]] != _NORMALISERS or [s["type"] for s in shape] != [
            "Split", "ByteLevel"
        ] or not shape[0]["invert"] or model["type"] != "BPE":
            raise ValueError("not a word-level BPE file")
        self._file, self._library = file, None
        pattern = shape[0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        narrow = pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
        self.ascii_pattern = re.compile(narrow, re.ASCII)
        self.special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        vocab = model["vocab"]
        self.merges = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(model["merges"])}
        self.made = [vocab[a + b] for a, b in model["merges"]]
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + model["end_of_word_suffix"]] for c in letters]
        self.memory: dict[str, array] = {}

    @property
    def library(self) -> Tokenizer:
        """The file's own tokenizer, loaded when a text first needs it."""
        if self._library is None:
            self._library = Tokenizer.from_str(self._file)
        return self._library

    def words(self, text: str) -> list[str]:
        """The words of a text in order; special tokens' strings are words of their own."""
        if "<|" in text:
            parts = self.special_pattern.split(text)
            if len(parts) > 1:
                return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_pattern.findall(text.lower())
        if AGREED.fullmatch(text):
            # Letters are lowered one by one, so a capital sigma never is a final one.
            return self.pattern.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        bytes_of = {c: b for b, c in enumerate(byte_letters())}
        return [bytes(bytes_of[c] for c in word).decode() for word, _ in split]

    def merge(self, word: str) -> list[int]:
        """The word's ids: the adjacent pair of least rank, leftmost first, until none is left."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode()
        ids = [*(self.inner[b] for b in data[:-1]), self.last[data[-1]]]
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        """Look at all pairs' ranks for each merge: cheapest while they are few."""
        find, made = self.merges.get, self.made
        ranks = [find(pair, NO_MERGE) for pair in zip(ids, ids[1:], strict=False)]
        while ranks:
            rank = min(ranks)
            if rank == NO_MERGE:
                break
            at = ranks.index(rank)
            ids[at : at + 2] = [made[rank]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = find((ids[at], ids[at + 1]), NO_MERGE)
            if at:
                ranks[at - 1] = find((ids[at - 1], ids[at]), NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """Keep the pairs in a heap and the ids in a linked list: n log n for any length."""
        n, merges, made = len(ids), self.merges, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(at: int, right: int) -> None:
            rank = merges.get((ids[at], ids[right]))
            if rank is not None:
                heapq.heappush(heap, (rank, at, ids[at], ids[right]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            nxt = after[at]
            if ids[at] != left or nxt >= n or ids[nxt] != right:
                continue  # one of the two has been merged since
            ids[at], ids[nxt] = made[rank], -1
            after[at] = after[nxt]
            if after[at] < n:
                before[after[at]] = at
                offer(at, after[at])
            if before[at] >= 0:
                offer(before[at], at)
        return [i for i in ids if i >= 0]

    def unseen(self, word: str) -> array:
        ids = self.memory.get(word)
        if ids is None:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            ids = array("i", self.merge(word))
            if len(word) <= LONGEST:
                self.memory[word] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    """One encoder a process."""
    return Encoder(file)


@lru_cache(maxsize=2)
def token_names(file: str) -> pa.Array:
    """The token of every id of a vocabulary file, all that decoding needs."""
    made = json.loads(file)
    vocab = made["model"]["vocab"] | {t["content"]: t["id"] for t in made["added_tokens"]}
    named = {i: t for t, i in vocab.items()}
    return pa.array([named.get(i) for i in range(max(named) + 1)], pa.string())


@lru_cache(maxsize=2)
def lexicon(name: str) -> Transducer:
    """The lexicon file that Spark brought to this machine; its pages are shared by all tasks."""
    return Transducer(SparkFiles.get(name))


def read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def word_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(word, n) over all texts; a task counts AT_ONCE different words before it passes them on."""
    file = docs.sparkSession.sparkContext.broadcast(read(path))

    def count(batches):
        words = encoder(file.value).words
        found: Counter = Counter()

        def flush():
            made = [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())]
            found.clear()
            return pa.RecordBatch.from_arrays(made, names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                found.update(words(text.as_py()))
                if len(found) >= AT_ONCE:
                    yield flush()
        if found:
            yield flush()

    return (
        bounded(docs.where("length(text) > 0").select("text")).mapInArrow(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


def publish(spark: SparkSession, data: bytes, name: str) -> str:
    """``data`` as a file in the shared folder that Spark brings to every executor; its name there."""
    context = spark.sparkContext
    name = f"{name}-{uuid.uuid4().hex}.bin"
    place = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    out = system.create(place)
    out.write(bytearray(data))
    out.close()
    context.addFile(system.makeQualified(place).toString())
    return name


def frequent(counts: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows of (word, n), those of highest count; of equal counts all or none.

    Words are counted by their count first, so no task and not the driver ever
    holds candidates that are not taken.
    """
    equal = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    so_far = F.sum("words").over(Window.orderBy(F.col("n").desc()))
    least = equal.withColumn("so_far", so_far).where(F.col("so_far") <= size).agg(F.min("n")).first()[0]
    return counts.where(F.lit(False) if least is None else F.col("n") >= least)


def build_lexicon(docs: DataFrame, path: str = VOCABULARY, size: int = LEXICON) -> str:
    """Compile the ``size`` most frequent words of ``docs`` with their ids; the file's name.

    Counts cover all texts; words beyond ``size`` or LONGEST bytes stay out and are
    merged when met, so the lexicon decides on speed and never on ids. The driver
    holds the lexicon alone, at most size words of LONGEST bytes.
    """
    short = stored(word_counts(docs, path).where(F.octet_length("word") <= LONGEST), "word-counts")
    common = frequent(short, size).select("word").collect()
    merge = encoder(read(path)).merge
    entries = sorted((row["word"].encode(), row["word"]) for row in common)
    return publish(docs.sparkSession, compile_words((key, merge(word)) for key, word in entries), "lexicon")


def _encoded(words: list[str], enc: Encoder, known: Transducer) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each word, and the ids of all."""
    coded = pa.array(words, pa.string()).dictionary_encode()
    distinct, at = coded.dictionary, coded.indices.to_numpy()
    done, sizes, ids = known.look_up(*raw_bytes(distinct))
    missing = np.flatnonzero(~done)
    merged = [enc.unseen(w) for w in distinct.take(pa.array(missing)).to_pylist()]
    # Places of each distinct word's ids: those of the lexicon first, then merged ones.
    starts = np.cumsum(sizes) - sizes
    lengths = np.fromiter(map(len, merged), np.int64, len(merged))
    ids_merged = np.frombuffer(b"".join(merged), np.dtype(merged[0].typecode)) if merged else np.zeros(0, np.int64)
    starts[missing] = len(ids) + np.cumsum(lengths) - lengths
    sizes[missing] = lengths
    flat = np.concatenate([ids, ids_merged])
    size = sizes[at]
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return size, flat[np.repeat(starts[at], size) + within]


def encode(docs: DataFrame, path: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",), size: int = LEXICON) -> DataFrame:
    """Columns ``keep`` and ``ids`` (array of int) of every row of ``docs`` (text, ...).

    Ids are those of the tokenizer library without added special tokens; a special
    token's string inside a text is its id, as there. Whole texts of any length are
    read, AT_ONCE words at a time, and a word's length only counts times its
    logarithm. A null or empty text, and one of white space, has no ids; repeated
    rows are all returned; an empty table gives an empty result; other columns are
    not read. Rows stay where they are.
    """
    spark = docs.sparkSession
    file, name = spark.sparkContext.broadcast(read(path)), build_lexicon(docs, path, size)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", ids array<int>"

    def run(batches):
        enc, known = encoder(file.value), lexicon(name)

        def flush(batch, first, words, counts):
            sizes, ids = _encoded(words, enc, known)
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            kept = batch.slice(first, len(counts))
            return pa.RecordBatch.from_arrays([*kept.columns[:-1], made], names=[*keep, "ids"])

        for batch in batches:
            first, words, counts = 0, [], []
            for text in batch.column(batch.num_columns - 1):
                found = enc.words(text.as_py() or "")
                words += found
                counts.append(len(found))
                if len(words) >= AT_ONCE:
                    yield flush(batch, first, words, counts)
                    first, words, counts = first + len(counts), [], []
            if counts:
                yield flush(batch, first, words, counts)

    sent = [F.col(f"`{c}`") for c in keep] + [F.col("text").alias("__text")]
    return bounded(docs.select(*sent)).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and ``decoded``: the tokens of ``ids`` joined by a space.

    That is what the library does for a vocabulary without a decoder, special
    tokens included; numbers that are no id, and nulls, are left out; null or no
    ids give an empty text.
    """
    file = rows.sparkSession.sparkContext.broadcast(read(path))

    def work(column: pa.Array) -> list[pa.Array]:
        names, made = token_names(file.value), []
        for first in range(0, len(column), 256):
            part = column.slice(first, 256)
            flat = pc.list_flatten(part)
            owner = pc.list_parent_indices(part).to_numpy()
            valid = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(names))), False)
            text = names.take(pc.if_else(valid, flat, pa.scalar(None, flat.type)))
            there = text.is_valid()
            owner = owner[there.to_numpy(zero_copy_only=False)]
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(part)))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), text.filter(there))
            made.append(pc.binary_join(lists, " "))
        return [pa.concat_arrays(made) if made else pa.array([], pa.string())]

    return text_map(rows, ids, list(keep), "decoded string", work)


@query("op11_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded: token counts and digests."""
    ids = encode(table(spark, sf_dir, "documents"))
    rows = decode(ids, keep=("doc_id", "ids"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
