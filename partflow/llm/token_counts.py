"""Token counts of whole texts, long ones by overlap resynchronisation.

A text longer than ``chunk_chars`` is encoded in overlapping chunks with token offsets.
Two neighbouring chunks are spliced where both have a token boundary that is proven
stable: a white-space character right after a non-space one. No alternative of the split
pattern and no special string holds a non-space character followed by white space, so
every encoding of the text, wherever it starts, breaks there and goes on alike. Where an
overlap holds no such boundary the overlap is doubled, and in the end the chunks become
one.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows each get their row.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import text_of, texts

#: (ids, start offsets in characters) of a text
Encode = Callable[[str], tuple[list[int], list[int]]]

#: Fixed value: the split pattern of byte-level BPE files that name none.
BYTE_LEVEL = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
              r"|\s+(?!\S)|\s+")


def _byte_level(spec: dict):
    """A tiktoken encoding equal to a plain byte-level BPE file of tokenizers (no
    normaliser, merges in id order), or None for any other file. It gives the same ids and
    runs several times faster, as it builds no alignment objects."""
    import tiktoken
    pre = spec.get("pre_tokenizer") or {}
    model = spec["model"]
    if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
            or not pre.get("use_regex", True) or model.get("type") != "BPE"
            or model.get("dropout") or model.get("ignore_merges")):
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    char = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
    if len(special) < len(spec["added_tokens"]):
        return None
    vocab = {k: v for k, v in model["vocab"].items() if k not in special}
    ids = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if ids != sorted(ids):
        return None
    ranks = {bytes(char[c] for c in k): v for k, v in vocab.items()}
    return tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks,
                             special_tokens=special)


def load_counter(path: str) -> tuple[Callable[[list[str]], list[int]], Encode]:
    """(counts of a list of texts, encode with offsets) for a tokenizer file."""
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def whole(ts):
            return [len(x) for x in sp.encode(list(ts), num_threads=1)]
        return whole, None                    # normalises white space: never cut
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken
        ranks = {base64.b64decode(a): int(b)
                 for a, b in map(bytes.split, open(path, "rb"))}
        enc = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN,
                                mergeable_ranks=ranks, special_tokens={})
    else:
        spec = json.load(open(path, encoding="utf-8"))
        enc = _byte_level(spec)
        if enc is None:
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)

            def count(ts):
                return [len(x) for x in tok.encode_batch_fast(list(ts),
                                                              add_special_tokens=False)]
            return count, None                # its normaliser may move offsets: never cut

    def counts(ts):
        return [len(enc.encode(t, allowed_special="all")) for t in ts]

    def offsets(t):
        ids = enc.encode(t, allowed_special="all")
        at, starts = 0, []
        for b in enc.decode_tokens_bytes(ids):
            starts.append(at)
            # A token that begins inside a character starts where that character does.
            at += sum((x & 0xC0) != 0x80 for x in b)
        return ids, starts
    return counts, offsets


def stable(text: str, i: int) -> bool:
    """White space right after a non-space character."""
    return text[i] in " \n\t" and not text[i - 1].isspace()


def spliced(text: str, encode: Encode, chunk: int, overlap: int) -> list[int]:
    """The ids of ``text`` from overlapping chunks of ``chunk`` characters."""
    out: list[int] = []
    start, cut, end = 0, 0, min(chunk, len(text))
    ids, starts = encode(text[start:end])
    while end < len(text):
        wide, found = overlap, -1
        while wide < end - start:
            nxt = end - wide
            nend = min(nxt + max(chunk, 2 * wide), len(text))
            nids, nstarts = encode(text[nxt:nend])
            both = {nxt + s for s in nstarts if s} & {start + s for s in starts}
            found = max((i for i in both if max(cut, nxt) < i < end and stable(text, i)),
                        default=-1)
            if found >= 0:
                break
            wide *= 2
        if found < 0:                         # no stable boundary: one longer chunk
            end = min(end + (end - start), len(text))
            ids, starts = encode(text[start:end])
            continue
        out += [t for t, s in zip(ids, starts) if cut <= start + s < found]
        start, cut, end, ids, starts = nxt, found, nend, nids, nstarts
    return out + [t for t, s in zip(ids, starts) if start + s >= cut]


def token_counts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                 chunk_chars: int = 32768, overlap: int = 256,
                 limit: int = 1024) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_tokens, over_limit."""
    out = pa.schema([("k", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    kind = docs.schema[key].dataType.simpleString()

    def count(batches):
        counts, encode = load_counter(tokenizer)
        for b in batches:
            ts = texts(b.column(1))
            n = [len(spliced(t, encode, chunk_chars, overlap))
                 if encode is not None and len(t) > chunk_chars else counts([t])[0]
                 for t in ts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in ts], pa.int64()),
                 pa.array(n, pa.int64())], schema=out)

    rows = (docs.select(F.col(key).cast("bigint").alias("k"), text_of(text).alias("t"))
            .mapInArrow(count, "k bigint, n_bytes bigint, n_tokens bigint"))
    return rows.select(F.col("k").cast(kind).alias(key), "n_bytes", "n_tokens",
                       (F.col("n_tokens") > limit).alias("over_limit"))
