import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fraudlane.llm import text_arrays as ta

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB zé\n\t.9漢", max_size=40)), min_size=1, max_size=8)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_windows_are_those_of_a_pattern(texts):
    words = ta.find_words(*ta.text_buffer(pa.array(texts, pa.string())), ta.NOT_SPACE, lower=True)
    hashes = words.hashes()
    known, spelled = {}, {}
    for d, text in enumerate(texts):
        a, b = words.bounds[d], words.bounds[d + 1]
        got = [words.buffer[words.starts[i] : words.ends[i]].tobytes().decode() for i in range(a, b)]
        assert got == words_of(text)
        for word, h in zip(got, hashes[a:b], strict=True):
            assert known.setdefault(word, h) == h and spelled.setdefault(h, word) == word
    first, values = ta.windows(words, hashes, 3)
    runs = [tuple(words_of(t)[i : i + 3]) for t in texts for i in range(len(words_of(t)) - 2)]
    assert len(first) == len(runs)
    assert len(set(values.tolist())) == len(set(runs))


def test_a_hash_does_not_depend_on_its_place_or_on_blocks():
    text = "abc " * 400_000 + "end"
    words = ta.find_words(*ta.text_buffer(pa.array([text])), ta.NOT_SPACE, lower=True)
    values = words.hashes()
    assert len(values) == 400_001 and len(np.unique(values)) == 2


def test_slices_hold_whole_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 900_000, None, "b" * 5_000_000, "", "c"]})
    parts = [*ta.slices(batch, "text")]
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist() and len(parts) > 1
