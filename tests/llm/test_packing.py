import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillspan.llm.packing import Ids, OpenBins, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
IDS = Ids(PATH, entries=50)


def check(docs, rows, capacity):
    tok = Tokenizer.from_file(PATH)
    want, bins = defaultdict(list), defaultdict(list)
    for r in docs.collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want[r.doc_id].append([(k, at, len(p), zlib.crc32(p.tobytes())) for k, at in enumerate(range(0, len(ids), capacity)) for p in [ids[at : at + capacity]]])
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    for d in want:
        assert sorted(got[d]) == sorted(x for doc in want[d] for x in doc)
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins), sum(r.length for r in rows)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n, total = check(docs, pack_documents(docs, PATH).collect(), 4096)
    assert n <= 1.05 * total / 4096 + 1


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, pack_documents(odd_docs, PATH, capacity=64, open_bins=3).collect(), 64)
    assert pack_documents(no_docs, PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcXYZ'sétÉßµªº²½«»¿× \n\t\x0b\x1c\x85\xad<|>019٣Σσ你Åİ"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_ids_are_the_tokenizer_s(text):
    assert np.frombuffer(IDS(text), "<u4").tolist() == IDS.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 32), max_size=200), st.integers(1, 9))
def test_bins(lengths, most):
    bins, fill = OpenBins(32, most), defaultdict(int)
    for n in lengths:
        b, at = bins.put(n)
        assert at == fill[b]
        fill[b] += n
        assert fill[b] <= 32 and bins.open <= most
