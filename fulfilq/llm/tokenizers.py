"""Public tokenizer vocabularies, read on the driver and shipped to tasks as bytes.

``folder`` is a parameter of every operator; only the driver reads it. A
vocabulary file is a few MB, and ``MAX_BYTES`` is checked before it is broadcast.
"""

from __future__ import annotations

import base64
import os
import re

from pyspark.sql import SparkSession

FOLDER = "/opt/tokenizers"
MAX_BYTES = 64 << 20
#: Splits text before the merges of the rank files (fixed value of those vocabularies).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: What white space means there (fixed values), and a length of run that the pattern still matches.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 1 << 16
_LONG = re.compile(f"[{SPACES}]{{{LONG_RUN},}}")

_loaded: dict = {}


def ship(spark: SparkSession, name: str, folder: str = FOLDER):
    """Broadcast of the bytes of vocabulary file ``name`` (size-checked)."""
    path = os.path.join(folder, name)
    if (size := os.path.getsize(path)) > MAX_BYTES:
        raise ValueError(f"{path} has {size} bytes; a vocabulary to broadcast may have {MAX_BYTES}")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def rank_encoder(shipped, name: str):
    """tiktoken encoding of a shipped rank file, built once per Python worker."""
    if name not in _loaded:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shipped.value.splitlines())}
        _loaded[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[name]


def encode_ordinary(encoding, text: str) -> list[int]:
    """Tokens of a whole text, as the encoding gives them, with white space runs of any length.

    The pattern matches a run but for its last character (that one goes with the
    word after it), or the whole run at the end of the text, as one piece; its
    matcher overflows on runs near a million. Such a piece is cut out here and
    encoded on its own; on either side of it the pattern matches as before.
    """
    if len(text) < LONG_RUN:
        return encoding.encode_ordinary(text)
    out, at = [], 0
    for m in _LONG.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        out += encoding.encode_ordinary(text[at : m.start()])
        out += encoding._core_bpe.encode_single_piece(text[m.start() : end].encode())
        at = end
    return out + encoding.encode_ordinary(text[at:])


def piece_encoder(shipped, name: str):
    """(sentencepiece processor, which ids are bytes) of a shipped model, built once per Python worker."""
    if name not in _loaded:
        import numpy as np
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=shipped.value)
        _loaded[name] = model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    return _loaded[name]
