import re

import numpy as np
import pyarrow as pa
import pytest

from martwright.llm.text import ALPHANUMERIC, NOT_SPACE, Hasher, as_bytes, row_chunks, words_of

TEXTS = ["ab cd", "", None, "cd\tab", "  ", "é日 x1-Y2\x00z", "ab", "ab", "\x0b\x0c\r\n a b "]


def plain(text, pattern):
    return [w.encode() for w in re.findall(pattern, text or "")]


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
@pytest.mark.parametrize(
    "pattern, kind", [(r"[^\x20\x09-\x0D]+", NOT_SPACE), (r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ALPHANUMERIC)]
)
def test_words_of_every_row(pattern, kind, limit):
    found = []
    for words in words_of(pa.array(TEXTS), kind, limit):
        assert words.first_row == len(found)
        for row in range(words.rows):
            own = range(words.row_words[row], words.row_words[row + 1])
            found.append([words.data[words.starts[i] : words.ends[i]].tobytes() for i in own])
    assert found == [plain(t, pattern) for t in TEXTS]


def test_slices_and_empty_columns():
    data, offsets = as_bytes(pa.array(["abc", None, "de"]).slice(1))
    assert data[offsets[0] : offsets[-1]].tobytes() == b"de" and len(offsets) == 3
    assert list(words_of(pa.array([], pa.string()), NOT_SPACE)) == []
    assert list(row_chunks(np.array([0, 5, 5, 9, 30]), 6)) == [(0, 2), (2, 3), (3, 4)]


def test_hashes_depend_on_content_alone():
    hasher, folded = Hasher(1), Hasher(2, fold_case=True)
    words = next(words_of(pa.array(["a bb ccc a bb ccc", "Ccc a A"]), NOT_SPACE))
    hashes = hasher.spans(words.data, words.starts, words.ends)
    tokens = "a bb ccc a bb ccc Ccc a A".split()
    assert [(hashes[i] == hashes[j]) for i in range(9) for j in range(9)] == [a == b for a in tokens for b in tokens]
    pairs = hasher.windows(hashes, 2)
    assert pairs[0] == pairs[3] and pairs[1] == pairs[4] and len(set(pairs.tolist())) == 6
    low = folded.spans(words.data, words.starts, words.ends)
    assert low[2] == low[6] and low[0] == low[8]
    assert len(hasher.windows(hashes[:1], 2)) == 0
