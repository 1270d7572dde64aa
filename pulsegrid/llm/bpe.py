"""BPE encoding and decoding by forced boundaries.

A merge joins two byte strings into a token, so no merge ever crosses a pair of bytes that stands inside no
token of the vocabulary. Such a pair is a certain cut: what lies on either side is encoded alone and the ids are
concatenated. A table of 256 x 256 pairs says where, for a whole batch of texts at once; equal fragments are
encoded once per task.

Texts are also split by a rule before the merges, and a fragment must be split as it is within its text. The rule
looks at a place from its left, or ahead at the end of white space, and takes an apostrophe with the letters after
it if nothing but a letter, digit or white space precedes. So a certain pair is no cut

* after white space, or inside a character;
* after an apostrophe, or before one that no ASCII letter or digit precedes.

White space other than blank, tab and line ends is not seen by pairs of bytes: it is looked for, and there is no cut after
it either. The strings of special tokens are cut out first.

Defined cases: null text is the empty text; the empty text has no ids and decodes to itself. Ids decode to their
bytes; bytes that are no UTF-8 become the replacement character, as in the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import query, rows_and, table, whole_row

FRAGMENTS = 150_000  # remembered fragments of a task; then it starts afresh
BATCH_BYTES = 1 << 20

SPACE = b" \t\n\r"
#: other white space, in UTF-8
RARE = re.compile(rb"[\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)"
                  rb"|\xe3\x80\x80")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def cut_table(tokens: list[bytes]) -> np.ndarray:
    """Which pairs of bytes are cuts: inside no token, and safe for the splitting rule."""
    cut = np.ones((256, 256), dtype=bool)
    for token in tokens:
        cut[list(token[:-1]), list(token[1:])] = False
    cut[list(SPACE)] = False
    cut[:, 0x80:0xC0] = False
    cut[ord("'")] = False
    plain = [b for b in range(128) if chr(b).isalnum()]
    cut[[b for b in range(256) if b not in plain], ord("'")] = False
    return cut


class Codec:
    """Encoder and decoder of one byte-level vocabulary in the tokenizers format."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True  # special strings are cut out before
        letter = {v: k for k, v in byte_letters().items()}
        self.special = {t["content"].encode(): t["id"] for t in json.loads(spec).get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {v: k for k, v in self.special.items()}
        for token, number in self.library.get_vocab(with_added_tokens=False).items():
            self.bytes_of.setdefault(number, bytes(letter[c] for c in token))
        self.cut = cut_table([x for n, x in self.bytes_of.items() if x not in self.special])
        self.specials = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or b"(?!)")
        self.known: dict[bytes, bytes] = {}

    def fragments(self, text: bytes) -> list[bytes]:
        if not text:
            return []
        at = np.frombuffer(text, np.uint8)
        certain = self.cut[at[:-1], at[1:]]
        for rare in RARE.finditer(text):
            certain[rare.end() - 1:rare.end()] = False
        cuts = [0, *(np.flatnonzero(certain) + 1).tolist(), len(text)]
        return [text[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        parts = []
        for text in texts:
            found, start = [], 0
            for special in self.specials.finditer(text):
                found += self.fragments(text[start:special.start()])
                found.append(special.group())
                start = special.end()
            parts.append(found + self.fragments(text[start:]) if start else self.fragments(text))
        if len(self.known) > FRAGMENTS:
            self.known.clear()
        known = self.known
        if not known:
            known.update((k, np.array([v], "<u4").tobytes()) for k, v in self.special.items())
        new = list({x for found in parts for x in found if x not in known})
        for x, ids in zip(new, self.library.encode_batch([x.decode() for x in new], add_special_tokens=False),
                          strict=True):
            known[x] = np.array(ids.ids, "<u4").tobytes()
        return [b"".join(map(known.__getitem__, found)) for found in parts]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encoded(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all), with n_tokens, ids and decoded; columns of these names are replaced.

    ``ids`` is binary, four bytes an id, the least first: what a training job maps into memory. ``tokenizer`` is a
    file of the tokenizers format on the driver; its content goes to the tasks, a few MB whatever the data.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_tokens", "ids", "decoded")]
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"), whole_row(keep).alias("row"))

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held = start = 0
        for at, value in enumerate(batch.column(0)):
            held += len(value.as_buffer())
            if held >= BATCH_BYTES:
                yield batch.slice(start, at + 1 - start)
                held, start = 0, at + 1
        if start < batch.num_rows:
            yield batch.slice(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec.value)
        for whole in batches:
            for batch in slices(whole):
                ids = codec.encode(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([codec.decode(x) for x in ids], pa.string())],
                    names=["row", "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(run, rows_and(rows, "row", "n_tokens bigint, ids binary, decoded string")).select(
        "row.*", "n_tokens", "ids", "decoded")


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_bpe")
def op2(spark, sf_dir):
    found = encoded(table(spark, sf_dir, "documents"), tokenizer_file(), keep=["doc_id"])
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
