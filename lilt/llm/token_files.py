"""Token ids in ORC: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are dealt into ranges of ascending id, each task encodes its sorted range and writes it as one file, so files
in order of their task's number and rows in file order are in ascending id order. ORC stores the ids with run-length encoding, keeps
minimum and maximum of doc_id by stripe and row group, and a Bloom filter on doc_id; stripes are read in parallel, and a
look-up of a document skips the others by these.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lilt.llm.common import Generations, append_columns, checkpoint_dir, cut, partitions

#: Words and pieces in a worker's younger memo; the older one has as many. The longest one remembered.
MEMO_WORDS, MEMO_PIECES, MEMO_BYTES = 450_000, 250_000, 64
#: Bytes of documents for a file.
FILE_BYTES = 256 << 20
#: Fixed value: the splitting pattern of the tokenizer's file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Printable ASCII and Latin letters, for which NFC is the identity and lower case goes character by character.
PLAIN = "[!-~¡-įı-ſ]+"
#: A text of ASCII and PLAIN characters alone.
PLAIN_TEXT = r"\A[\x00-\x7F¡-įı-ſ]*\z"
#: A lower-case ASCII letter and the ASCII character after it, if that is no letter and no white space.
AFTER_LETTER = r"([a-z])([!-@\[-`{-~])"


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = (chr(256 + i) for i in range(256))
    return [chr(b) if b in shown else next(other) for b in range(256)]


class WordTokenizer:
    """A tokenizer of the tokenizers library that drops white space, asked once for each new word or piece of a word.

    Its splitting rule and its normaliser never cross white space, so a text's ids are its words' ids in order. Words of
    PLAIN characters are split by the same rule here, so that variants in case and punctuation share pieces, and the
    library's model encodes each new piece; other new words go through the whole tokenizer as they are, since it composes
    characters before it lower-cases them. A special token's string in a text is that token, as in the library.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the worker is one of many on its machine
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip or re.search(r"\s", t.content) for t in added.values()):
            raise ValueError("added tokens must be matched as they stand, wherever they stand")
        self.special = {t.content.encode(): array("i", [i]).tobytes() for i, t in added.items()}
        self.any_special = "(" + "|".join(sorted((re.escape(t.content) for t in added.values()), key=len, reverse=True)) + ")"
        self.words, self.pieces, self.letters = Generations(MEMO_WORDS), Generations(MEMO_PIECES), byte_letters()
        self.plain, self.split = re.compile(PLAIN).fullmatch, regex.compile(PIECES).findall

    def learn(self, new: list[bytes]) -> None:
        """Puts the packed ids of new words into the younger memo."""
        words, split, other = self.words.young, {}, []
        pieces, letters, tokenize = self.pieces.young, self.letters, self.tokenizer.model.tokenize
        for w in new:
            if w in self.special:
                words[w] = self.special[w]
            elif w.isalpha():  # ASCII letters alone are one piece, and the memo of words has it
                words[w] = array("i", [t.id for t in tokenize(w.decode().lower())]).tobytes()
            elif self.plain(text := w.decode(errors="replace")):
                split[w] = self.split(text.lower())
            else:
                other.append((w, text))
        fresh = self.pieces.lacking({p for own in split.values() for p in own})
        for p in fresh:
            shown = p if p.isascii() else "".join([letters[b] for b in p.encode()])
            pieces[p] = array("i", [t.id for t in tokenize(shown)]).tobytes()
        for w, own in split.items():
            words[w] = b"".join(map(pieces.__getitem__, own))
        for at in range(0, len(other), 2000):
            part = other[at : at + 2000]
            found = self.tokenizer.encode_batch_fast([text for _, text in part], add_special_tokens=False)
            for (w, _), e in zip(part, found, strict=True):
                words[w] = array("i", e.ids).tobytes()
        self.pieces.trim(MEMO_BYTES)

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each word."""
        found = list(map(self.words.young.get, words))
        if None in found:
            new = self.words.lacking({w for w, ids in zip(words, found, strict=True) if ids is None})
            self.learn(new)
            found = list(map(self.words.young.__getitem__, words))
            self.words.trim(MEMO_BYTES)
        return found

    def encode(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """Ids of each text with end_id appended: words are numbered in Arrow, and only different ones are looked up.

        In texts of PLAIN characters without special tokens, A-Z in lower case and a blank after a letter that isn't followed
        by one change no ids, since nothing composes, the tokenizer lower-cases and it always splits there; they leave fewer
        different words. Special tokens are set apart by blanks; other texts stay as they are.
        """
        texts = texts.fill_null("")
        plain = pc.match_substring_regex(texts, PLAIN_TEXT)
        if self.special:
            marked = pc.match_substring_regex(texts, self.any_special)
            plain = pc.and_not(plain, marked)
            if pc.any(marked).as_py():
                texts = pc.if_else(marked, pc.replace_substring_regex(texts, self.any_special, r" \1 "), texts)
        if pc.all(plain).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), AFTER_LETTER, r"\1 \2")
        else:
            texts = pc.if_else(plain, pc.replace_substring_regex(pc.ascii_lower(texts), AFTER_LETTER, r"\1 \2"), texts)
        split = pc.ascii_split_whitespace(texts)
        numbered = split.flatten().dictionary_encode()
        packed = self.ids_of(numbered.dictionary.cast(pa.binary()).to_pylist()) + [array("i", [end_id]).tobytes()]
        lengths = np.fromiter(map(len, packed), np.int32, len(packed)) // 4
        starts, ids = np.cumsum(lengths, dtype=np.int32) - lengths, np.frombuffer(b"".join(packed), "<i4")
        ends = np.asarray(split.offsets)
        ends = ends - ends[0]
        words = np.insert(np.asarray(numbered.indices), ends[1:], len(packed) - 1)
        each = lengths[words]
        stops = np.zeros(len(words) + 1, np.int32)
        np.cumsum(each, out=stops[1:])
        place = np.repeat(starts[words] - stops[:-1], each)
        place += np.arange(len(place), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(stops[ends + np.arange(len(ends))]), pa.array(ids[place]))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def encode(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, ids): ids array<int> of each whole text with end_id appended; row counts a task's rows from 0.

    A null or empty text is the end id alone.
    """

    def make():
        if tokenizer_path not in _TOKENIZERS:
            _TOKENIZERS[tokenizer_path] = WordTokenizer(tokenizer_path)
        tokenizer, rows = _TOKENIZERS[tokenizer_path], [0]

        def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
            first, rows[0] = rows[0], rows[0] + batch.num_rows
            return [batch.column(id_col), pa.array(range(first, rows[0]), pa.int64()), tokenizer.encode(batch.column(text_col), end_id)]

        return kernel

    fields = [T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return append_columns(docs.select(F.col(id_col).cast("long").alias(id_col), text_col), make, fields).select("doc_id", "row", "ids")


SCHEMA = "doc_id long, row long, ids array<int>"


def planned_bytes(docs: DataFrame) -> int:
    """The optimizer's estimate of a table's bytes, from the sizes of its files; 0 where it has none."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, stripe_mb: int = 16, stride: int = 1000) -> None:
    """Writes the ids of docs (doc_id, text) as ORC files in ascending doc_id order.

    Null ids come first; rows that share an id stand together, ordered by text. An empty table leaves a folder without
    rows. The files are written by Spark's committer, so a lost executor's task is simply run again.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    tasks = partitions(docs.sparkSession, planned_bytes(docs), FILE_BYTES)
    ranged = docs.select("doc_id", "text").repartitionByRange(tasks, order[0]).sortWithinPartitions(*order)
    (
        encode(ranged, tokenizer_path, end_id)
        .write.mode("overwrite")
        .option("orc.compress", "LZ4")
        .option("orc.stripe.size", str(stripe_mb << 20))
        .option("orc.row.index.stride", str(stride))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, row, ids, file) from files that write() made."""
    return spark.read.schema(SCHEMA).orc(path).select("doc_id", "row", "ids", F.col("_metadata.file_name").alias("file"))


def file_number(file: Column) -> Column:
    """The number of the task that wrote a file: part-00012-..., and part-100000-... after part-99999-...."""
    return F.regexp_extract(file, r"^part-(\d+)", 1).cast("long")


def look_up(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """One document's rows; ORC skips stripes and row groups by minimum, maximum and Bloom filter."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id") == doc_id)


def layout(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files.

    start counts the ids of all documents before it: totals of the files before (one row a file) plus a running sum
    inside the file.
    """

    def make():
        def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
            ids = batch.column("ids")
            values, ends = memoryview(np.asarray(ids.values).astype("<i4", copy=False)).cast("B"), np.asarray(ids.offsets).tolist()
            return [pa.array([zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)], pa.int64())]

        return kernel

    rows = append_columns(read(spark, path).withColumn("n_tokens", F.size("ids").cast("long")), make, [T.StructField("ids_crc32", T.LongType())])
    stored = cut(rows.drop("ids"))  # a short row a document, read twice below; the files are read once
    before = Window.partitionBy(F.lit(0)).orderBy(file_number(F.col("file")), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = stored.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return stored.join(files, "file").select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/token-files-{uuid4().hex}"
