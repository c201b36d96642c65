"""Helpers shared by the operators: staging, words, token ids.

A word is a maximal run of characters other than the ASCII white space
``\\x20 \\x09-\\x0D``; ``bytes.split()`` splits by exactly that set, so texts
are handled as UTF-8 bytes."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from array import array
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.session import shared_path

SPACES = " \t\n\u000b\u000c\r"


# ---------------------------------------------------------------- staging

def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, with its scheme (so that tasks that
    write there themselves mean the same store as Spark does), deleted when the
    session's JVM ends."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_path(spark, name))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


#: A Spark setting (4.1 and later; others ignore it): a finished query's shuffle files are deleted.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is computed once,
    and a lost executor costs a read, not a recomputation.  What the write has
    exchanged goes from disk when it ends, not when the driver happens to
    collect its garbage."""
    path, conf = new_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, so that their
    Python workers can import it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_stagewise_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="stagewise-ship-"), "stagewise_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(target)
    context._stagewise_shipped = True


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    shipped(df.sparkSession)
    return df.mapInArrow(function, schema)


# ---------------------------------------------------------------- columns

def words_column(text: Column | str) -> Column:
    """array<string> of the words of a text; null and blank texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) > 0,
                  F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.expr("array()").cast("array<string>"))


def crc32_text(text: Column | str) -> Column:
    """Unsigned crc32 of the UTF-8 bytes (null text: of no bytes)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


# ---------------------------------------------------------------- Arrow batches

def raw(column: pa.Array) -> list[bytes]:
    """A string column as bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def gathered(batches: Iterable[pa.RecordBatch], text: str = "text",
             most_rows: int = 4096, most_bytes: int = 16 << 20) -> Iterator[pa.Table]:
    """Arrow batches joined to blocks of bounded size (one row at least)."""
    held, rows, size = [], 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            held.append(part)
            rows += part.num_rows
            size += part.column(text).nbytes if text else 0
            if rows >= most_rows or size >= most_bytes:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows, size = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


class WordHashes(dict):
    """word (bytes) → 64-bit hash; forgets everything when it has grown full."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def windows_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n-word window (empty if the text is shorter)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out = out * _STEP + h[i: len(h) - n + 1 + i]
    return mixed(out)


# ---------------------------------------------------------------- token ids

# Characters that NFC leaves alone and that lower-case one by one: printable
# ASCII and the Latin letters up to U+017F (without U+0130).
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017f]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: visible
    Latin-1 characters stand for themselves, the others for U+0100 onwards."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


# The settings of a vocabulary file whose ids can be made word by word.
_BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None}


class TokenIds(dict):
    """word (bytes) → its token ids as little-endian uint32 bytes.

    Where the vocabulary file drops white space and never joins tokens across
    it (its settings are compared on load), a text's ids are those of its words
    in a row.  For Latin words the normaliser lower-cases and the pre-tokeniser
    splits by the pattern in the file, which is applied here once per distinct
    word before the library's BPE model; other words take the library's whole
    path.  With any other file, whole texts do."""

    def __init__(self, path: str, most: int = 800_000):
        super().__init__()
        import json
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.by_word = all(settings.get(k) == v for k, v in _BY_WORD.items()) and settings["model"]["type"] == "BPE"
        self.size = self.tokenizer.get_vocab_size()
        self.model, self.most, self.pieces = self.tokenizer.model, most, {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        if word.isalpha():                                    # ASCII letters: one piece
            value = self[word] = self._piece(word.lower().decode())
            return value
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            value = b"".join(map(self._piece, _PIECES.findall(text.lower())))
        else:
            value = self._whole(text)
        self[word] = value
        return value

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        value = self.pieces.get(piece)
        if value is None:
            if len(self.pieces) >= self.most:
                self.pieces.clear()
            mapped = piece if piece.isascii() else "".join(map(_LETTERS.__getitem__, piece.encode()))
            value = self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        return value

    def of(self, text: bytes, end: int) -> bytes:
        if not self.by_word:
            return self._whole(text.decode("utf-8", "replace")) + int(end).to_bytes(4, "little")
        return b"".join(map(self.__getitem__, text.split())) + int(end).to_bytes(4, "little")


_LOADED: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The worker's own encoder, loaded once per Python process."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
