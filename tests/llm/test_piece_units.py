"""op10: units of words that are cut once equal those of whole texts."""
import gc

import numpy as np
import pyarrow as pa

from opsflow.llm import piece_lattice as L

PIECES = ["▁", "a", "b", "c", "▁a", "ab", "▁▁", "bc"]
TEXTS = ["", " ", "a", "  a b", "ab  cab ", "▁a▁▁b", "a\n b\nc", "ab ab ab", "日本 ab", "\n", "x" * 30 + " abc"]


def by_text(texts, units_of):
    numbers = {L.LINE_END: 0}
    used = [[numbers.setdefault(u, len(numbers)) for u in units_of(t)] for t in texts]
    return list(numbers), used


def test_units_of_words_equal_units_of_texts():
    for pieces in (PIECES, [*PIECES, "c▁"]):  # with a piece that goes on over a word's start, texts are cut whole
        letters, bits = L.neighbours(pieces)
        finder = L.cut_finder(letters, bits)
        assert finder[1] == ("c▁" not in pieces)
        units, used = by_text(TEXTS, L.unit_cutter(letters, bits))
        got, numbers = L.numbered_units(TEXTS, finder)
        assert (got, [n.tolist() for n in numbers]) == (units, used)
        assert L.distinct_units(TEXTS, finder) == units
    assert L.numbered_units([], finder) == ([L.LINE_END], [])


def test_each_word_is_cut_once():
    letters, bits = L.neighbours(PIECES)
    cuts_in, by_word = L.cut_finder(letters, bits)
    seen = []
    L.numbered_units(["ab abc"] * 50, (lambda shown: seen.append(shown) or cuts_in(shown), by_word))
    assert seen == ["▁ab▁abc"] and np.array_equal(cuts_in(seen[0]), [3])


def test_a_pack_leaves_nothing_to_the_search_for_cycles():
    """Else a scan task's memory grows with its rows: the words of all packs stay until Python looks for cycles."""
    finder = L.cut_finder(*L.neighbours(PIECES))
    gc.collect()
    gc.disable()
    try:
        for cut in (L.distinct_units, L.numbered_units):
            cut(TEXTS, finder)
            assert gc.collect() == 0, cut.__name__
    finally:
        gc.enable()


def test_one_pack_is_held_at_a_time():
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4, 5], "text": ["ab " * 10] * 5})
    held, sizes = [], []
    for pack, ids, texts in L.packs(iter([rows]), 60):
        assert not any(map(len, held))
        sizes.append((list(ids), len(texts)))
        held += [ids, texts]
    assert sizes == [([1, 2], 2), ([3, 4], 2), ([5], 1)]
