"""BPE encoding and decoding with tree concatenation for long texts.

Texts up to ``PIECE`` code points are encoded whole. Longer ones are halved until the pieces fit, the pieces are
encoded in parallel as rows of their own, and neighbours are joined as a tree: the text around a join is encoded
again in a window that doubles until its tokens agree with both sides. Encodings agree at a token boundary only
if all pairs of neighbouring tokens are ones that the merges would make, so the joined ids are those of the whole
text; a window that never agrees grows to both whole halves.

The tokenizer file is a parameter and is read by each Python worker, so its path must exist on every node.

Defined results: a null text is an empty one (no ids, decoded empty); special tokens in a text become their ids, as
the library does by default; rows are independent, so repeated rows give repeated results (of long texts one is encoded
for all rows with its doc_id); doc_ids may be of any type with a text form; columns other than doc_id and text are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kind_of

#: Longest text, in code points, that is encoded in one piece.
PIECE = 1 << 16
#: Tokens on each side of a join in the first window.
WINDOW = 8
#: Texts encoded and decoded at once, in bytes.
AT_ONCE = 1 << 20
#: A good place to halve: before the space of a following word.
WORD_END = re.compile(r"[A-Za-z0-9](?= [A-Za-z])")

# Fixed value: the split pattern that byte-level BPE files imply.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

RESULT = "ids array<int>, decoded string"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def byte_letters() -> dict[str, int]:
    """The byte of each letter: byte-level vocabularies write a printable byte as itself and the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def token_bytes(path: str) -> dict[int, bytes]:
    """Bytes of each id."""
    of, t = byte_letters(), tokenizer(path)
    special = {i: a.content.encode() for i, a in t.get_added_tokens_decoder().items()}
    return {i: bytes(of[c] for c in s) for s, i in t.get_vocab(with_added_tokens=False).items() if i not in special} | special


@cache
def merges_by_rank(path: str):
    """The same encoding by token ranks, several times as fast; None if the file's rules are other than plain byte-level BPE.

    Ranks stand for merges if ids rise with the merges, and the split pattern is the one that byte-level files imply.
    """
    import tiktoken

    rules = json.loads(tokenizer(path).to_str())
    model, split = rules["model"], rules["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE" and rules["normalizer"] is None and split.get("type") == "ByteLevel" and split["use_regex"]
        and not split["add_prefix_space"] and not model["dropout"] and not model.get("ignore_merges")
        and not model["continuing_subword_prefix"] and not model["end_of_word_suffix"]
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in rules["added_tokens"])
    )
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]] if plain else []
    if not plain or made != sorted(made):
        return None
    special = {t["content"]: t["id"] for t in rules["added_tokens"]}
    ranks = {b: i for i, b in token_bytes(path).items() if i not in special.values()}
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encode_texts(texts: list[str], path: str) -> list[list[int]]:
    """As the tokenizer's encode without added special tokens; those that stand in a text become their ids."""
    fast = merges_by_rank(path)
    if fast is not None:
        return [fast.encode(t, allowed_special="all") for t in texts]
    return [e.ids for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def decode_ids(ids: list[list[int]], path: str) -> list[str]:
    """As the tokenizer's decode with special tokens kept."""
    fast = merges_by_rank(path)
    return [fast.decode(i) for i in ids] if fast is not None else tokenizer(path).decode_batch(ids, skip_special_tokens=False)


def halves(text: str, piece: int = PIECE) -> list[str]:
    """The text cut in halves until no part is longer than ``piece``, near a word's end where there is one."""
    if len(text) <= piece:
        return [text]
    middle = len(text) // 2
    near = WORD_END.search(text, middle, middle + piece // 4)
    cut = near.end() if near else middle
    return halves(text[:cut], piece) + halves(text[cut:], piece)


def join(left: list[int], right: list[int], path: str, window: int = WINDOW) -> list[int]:
    """Ids of the text of ``left`` followed by that of ``right``, each the encoding of its own text."""
    if not left or not right:
        return left + right
    of = token_bytes(path)
    while True:
        w = window
        while True:  # both ends of the window must be ends of characters
            a, b = left[-w:], right[:w]
            try:
                text = b"".join(of[i] for i in [*a, *b]).decode()
                break
            except UnicodeDecodeError:
                w += 1
        new = encode_texts([text], path)[0]
        k = w // 2
        left_agrees = w >= len(left) or new[:k] == a[:k]
        right_agrees = w >= len(right) or new[-k:] == b[-k:]
        if left_agrees and right_agrees:
            return left[: max(0, len(left) - w)] + new + right[w:]
        window = 2 * w


def join_all(parts: list[list[int]], path: str) -> list[int]:
    """Neighbours are joined in rounds, as a tree."""
    while len(parts) > 1:
        parts = [join(*parts[i : i + 2], path) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else []


def _arrow(doc_ids: pa.Array, ids: list[list[int]], decoded: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]
    )


def _groups(texts: list[str]):
    """Slices of about AT_ONCE code points."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= AT_ONCE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_decode(docs: DataFrame, path: str | None = None, piece: int = PIECE) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) for each row of ``docs``."""
    path = path or default_path()
    kind = kind_of(docs, "doc_id")
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def whole(frames):
        for batch in frames:
            texts = batch.column("text").to_pylist()
            for a, b in _groups(texts):
                ids = encode_texts(texts[a:b], path)
                yield _arrow(batch.column("doc_id").slice(a, b - a), ids, decode_ids(ids, path))

    def cut(frames):
        for frame in frames:
            for row in frame.itertuples():
                parts = halves(row.text, piece)
                yield pd.DataFrame({"doc_id": [row.doc_id] * len(parts), "digest": row.digest, "n": row.n, "place": range(len(parts)), "part": parts})

    def encode(frames):
        for frame in frames:
            yield frame.drop(columns="part").assign(ids=encode_texts(list(frame["part"]), path))

    def concatenate(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("place")
        ids = join_all([list(map(int, x)) for x in parts["ids"]], path)
        return pd.DataFrame({"doc_id": parts["doc_id"].iloc[:1], "n": parts["n"].iloc[:1], "ids": [ids], "decoded": decode_ids([ids], path)})

    short = base.where(F.length("text") <= piece).mapInArrow(whole, f"doc_id {kind.simpleString()}, {RESULT}")
    # pieces are named by doc_id and the text's digest, so that a task that runs again names them alike
    long_ = (
        base.where(F.length("text") > piece)
        .groupBy(F.col("doc_id").cast("string").alias("doc_id"), F.sha2("text", 256).alias("digest"))
        .agg(F.first("text").alias("text"), F.count("*").alias("n"))
        .mapInPandas(cut, "doc_id string, digest string, n long, place int, part string")
        .repartition("doc_id", "digest", "place")
        .mapInPandas(encode, "doc_id string, digest string, n long, place int, ids array<int>")
        .groupBy("doc_id", "digest")
        .applyInPandas(concatenate, f"doc_id string, n long, {RESULT}")
        .select(F.col("doc_id").cast(kind).alias("doc_id"), "ids", "decoded", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .drop("col")
    )
    return short.unionByName(long_)
