"""Counts that describe a text's form, for whole chunks of documents at once."""

from __future__ import annotations

import numpy as np

from tidewalk.llm.shingles import find_words, mix, span_hashes

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
#: Words in a row that make a repeated window.
WINDOW = 5

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_loud", "n_common", "n_plain_words")

# Function words of four languages, each a sign of running text.
FUNCTION_WORDS = (
    "the of and to in is that for it as with was on are this by from or be at an which not "
    "de la le les et des un une est que pour dans en du qui il elle sur par avec pas au ne se ce sont plus "
    "der die das und ist von zu den mit sich auf nicht ein eine dem des im auch als an es wird oder aus bei "
    "el los las y que del por con una para es no se lo su al como más pero sus"
)


def _per_doc(mask_or_weight: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=mask_or_weight, minlength=n).astype(np.int64)


def _between(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set in each document."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    at = np.concatenate([[0], ends])
    return total[at[1:]] - total[at[:-1]]


def _lookup(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL = _lookup(SYMBOLS)
_UPPER, _LOWER, _LOUD = _lookup(bytes(range(65, 91))), _lookup(bytes(range(97, 123))), _lookup(b"!?")
_LETTER = _UPPER | _LOWER | _lookup(bytes(range(128, 256)))


def _common() -> np.ndarray:
    words = sorted({w.encode() for w in FUNCTION_WORDS.split()})
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    return np.sort(find_words(data, np.array([len(data)])).hash)


_COMMON = _common()


def text_stats(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """The counts named in ``STATS`` for each document of a chunk.

    ``word_chars``: code points in words.  ``n_dup_lines``: lines with a word that equal
    an earlier line.  ``n_repeat_words``: words that lie in a window of five which the
    text has twice or more.  ``n_lines``: lines with a word.  ``n_loud``: ! and ?.
    ``n_common``: function words.  ``n_plain_words``: words that begin with a letter and
    have no symbol.
    """
    n = len(ends)
    words = find_words(data, ends, fold=False)
    out = {name: np.zeros(n, np.int64) for name in STATS}
    if len(words.starts) == 0:
        return out | {"n_symbols": _between(_SYMBOL[data], ends)}
    doc, total = words.doc, len(words.starts)
    out["n_words"] = np.bincount(doc, minlength=n)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    out["word_chars"] = _per_doc(begins[words.stops] - begins[words.starts], doc, n)
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_lower", _LOWER), ("n_loud", _LOUD)):
        out[name] = _between(table[data], ends)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data], dtype=np.int64)])
    plain = _LETTER[data[words.starts]] & (symbols[words.stops] == symbols[words.starts])
    out["n_plain_words"] = _per_doc(plain, doc, n)
    folded = find_words(data, ends).hash
    place = np.minimum(np.searchsorted(_COMMON, folded), len(_COMMON) - 1)
    out["n_common"] = _per_doc(_COMMON[place] == folded, doc, n)

    # Lines: spans between line ends and documents' ends that hold a word.
    stops = np.union1d(np.flatnonzero(data == 10), ends)
    starts = np.concatenate([[0], stops[:-1] + (data[np.minimum(stops[:-1], len(data) - 1)] == 10)])
    stops = np.maximum(stops, starts)
    holds = np.searchsorted(words.starts, stops) > np.searchsorted(words.starts, starts)
    starts, stops = starts[holds], stops[holds]
    line_doc = np.searchsorted(ends, starts, side="right")
    keys = span_hashes(words.sums, starts, stops) + mix(line_doc.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(keys, return_index=True)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_doc[first], minlength=n)

    # Windows: five words of one document; those met twice cover their words.
    if total >= WINDOW:
        whole = doc[WINDOW - 1 :] == doc[: total - WINDOW + 1]
        acc = np.zeros(total - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            acc = acc * np.uint64(0xD6E8FEB86659FD93) + words.hash[k : total - WINDOW + 1 + k]
        at = np.flatnonzero(whole)
        keys = mix(acc[at]) + mix(doc[at].astype(np.uint64) + np.uint64(1))
        _, back, often = np.unique(keys, return_inverse=True, return_counts=True)
        twice = at[often[back] > 1]
        edge = np.zeros(total + 1, np.int64)
        np.add.at(edge, twice, 1)
        np.add.at(edge, twice + WINDOW, -1)
        out["n_repeat_words"] = _per_doc(np.cumsum(edge[:-1]) > 0, doc, n)
    return out
