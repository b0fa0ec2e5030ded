import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewell.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


WHOLE = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return WHOLE


def squares(lengths, capacity):
    """Every choice tried, its sum of squares counted anew."""
    gaps, places = [], []
    for s in lengths:
        def cost(i):
            after = gaps + [capacity - s] if i is None else gaps[:i] + [gaps[i] - s] + gaps[i + 1 :]
            counts = defaultdict(int)
            for g in after:
                counts[g] += g > 0
            return sum(n * n for n in counts.values())

        choices = [(cost(i), g, i) for i, g in enumerate(gaps) if g >= s] + [(cost(None), capacity, None)]
        best = min(choices, key=lambda c: (c[0], c[1], -1 if c[2] is None else -c[2]))
        if best[2] is None:
            gaps.append(capacity - s)
        else:
            gaps[best[2]] -= s
        places.append(best[:2])
    return gaps, places


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 12), max_size=40))
def test_each_place_has_the_least_sum_of_squares(lengths):
    places, offsets, gaps = packing.sum_of_squares(lengths, 12)
    assert sorted(gaps) == sorted(squares(lengths, 12)[0])
    assert [12 - o for o in offsets] == [g for _, g in squares(lengths, 12)[1]]
    ends = defaultdict(int)
    for s, place, offset in zip(lengths, places, offsets):
        assert offset == ends[place]
        ends[place] += s
    assert all(12 - ends[i] == g for i, g in enumerate(gaps))


def test_lengths_that_fit_no_sequence_are_refused():
    with pytest.raises(ValueError):
        packing.sum_of_squares([13], 12)


@settings(deadline=None, max_examples=150)
@given(text=st.text(st.one_of(
    st.characters(codec="utf-8"),
    st.sampled_from(" \t\n\x0b\x0c\r\x1c\x85\xa0 　́ΣσςİKÅ'sSt<|endoftext|>1234.,-"),
), max_size=60))
def test_parts_give_the_ids_of_whole_texts(text):
    assert packing.ids_of(PATH).encode([text, text + " <|endoftext|>a"])[0].tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_memory_is_bounded_and_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 2000)
    coder = packing.Ids(PATH)
    for k in range(50):
        texts = [f"w{(i * k) % 97}x plain {'long' * 20}{i}" for i in range(30)]
        assert [i.tolist() for i in coder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(coder.known) + len(coder.older) < 200
        assert all(len(p) <= packing.LONG_PART for p in coder.known)


def test_only_vocabularies_without_blanks_are_taken_apart():
    assert packing.drops_blanks(PATH)
    assert not packing.drops_blanks(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, library, capacity):
    """Pieces are the documents' ids cut at the capacity; sequences are filled without gaps or overlaps."""
    sequences, wanted = defaultdict(list), defaultdict(int)
    for doc_id, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            wanted[doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    for r in rows:
        wanted[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] -= 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert not any(wanted.values())
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity, share", [(4096, 1 << 16), (64, 5), (7, 3)])
def test_odd_documents(odd_docs, library, capacity, share):
    rows = packing.pack_documents(odd_docs, PATH, 1, capacity, share).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], library, capacity)


def test_no_documents(no_docs):
    done = packing.pack_documents(no_docs, PATH, 1)
    assert done.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and not done.collect()


def test_whole_table_is_packed_almost_without_waste(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    one = check(packing.op11_best_fit_packing(spark, sf_dir).collect(), texts, library, 4096)
    # Many small tasks come close to one task: what they leave open is packed again.
    many = check(packing.pack_documents(docs, PATH, 1, share=25).collect(), texts, library, 4096)
    least = -(-sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts) // 4096)
    assert one <= least + 2 and many <= least + 4
