import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import words
from tidepool.llm import hashing

TEXT = st.text(alphabet="aBé \t\n\x1c0日", max_size=30)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 40))
def test_words_and_windows(texts, most):
    seen = 0
    for part in hashing.text_slices(pa.array(texts, pa.string()), most):
        found = hashing.words_of(part)
        plain = hashing.word_hashes(part, found)
        lower = hashing.word_hashes(part, found, lower=True)
        windows = hashing.window_hashes(plain, found.bounds, 3, short=True)
        for r in range(part.rows):
            want = words(texts[part.first + r])
            at = range(found.bounds[r], found.bounds[r + 1])
            assert [part.data[found.starts[i] : found.ends[i]].tobytes().decode() for i in at] == want
            for i, w in zip(at, want, strict=True):
                alone = next(iter(hashing.text_slices(pa.array([w.replace("B", "b")]))))
                assert lower[i] == hashing.word_hashes(alone, hashing.words_of(alone))[0]
            want_windows = max(len(want) - 2, 1 if want else 0)
            assert windows.bounds[r + 1] - windows.bounds[r] == want_windows
        seen += part.rows
    assert seen == len(texts)


def test_equal_windows_have_equal_hashes():
    part = next(iter(hashing.text_slices(pa.array(["a b c d", "x a b c", "a b", "b a"]))))
    found = hashing.words_of(part)
    w = hashing.window_hashes(hashing.word_hashes(part, found), found.bounds, 3, short=True)
    rows = [w.hashes[a:b].tolist() for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    assert rows[0][0] == rows[1][1]
    assert len({*rows[0], *rows[1], *rows[2], *rows[3]}) == 5
    sets = hashing.distinct_in_rows(hashing.Windows(np.array([3, 1, 3, 2], dtype=np.uint64), np.array([0, 3, 3, 4])))
    assert sets.hashes.tolist() == [1, 3, 2] and sets.bounds.tolist() == [0, 2, 2, 3]
