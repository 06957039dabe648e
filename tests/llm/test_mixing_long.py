"""A document too long for what is left takes nothing from those after it."""

from tidemark.llm import mixing


def test_one_document_of_most_of_a_source(documents):
    docs = [(i, "w " * 10, "en", "a") for i in range(400)]
    names = [f"b{k:02}" for k in range(12)]
    for k, s in enumerate(names):
        docs += [(1000 * (k + 1), "w " * 600, "en", s)] + [(1000 * (k + 1) + i, "w " * (1 + i % 9), "en", s) for i in range(1, 81)]
    out = mixing.mix(documents(docs), share=0.29).collect()
    assert len(out) == len(docs)
    source, taken, target = {d[0]: d[3] for d in docs}, {}, {}
    for r in out:
        s = source[r["doc_id"]]
        taken[s], target[s] = taken.get(s, 0) + r["taken"], r["target"]
    long_in = {source[r["doc_id"]] for r in out if r["size"] == 600 and r["copies"]}
    assert all(abs(taken[s] - target[s]) <= 5 for s in target if s not in long_in)


def test_a_source_whose_longest_document_is_most_of_it(documents):
    # 60,000 words and 800 documents of 50; 140,000 words are to be taken
    for first in (0, 3000, 77000, 123456, 9_000_000):
        docs = [(first, "w " * 60000, "en", "a")] + [(first + i, "w " * 50, "en", "a") for i in range(1, 801)]
        out = mixing.mix(documents(docs), share=1.4).collect()
        longest = max(r["size"] for r in out if r["copies"] > 1)
        assert abs(sum(r["taken"] for r in out) - 140_000) <= longest / 2 + 1e-6


def test_longer_documents_are_likelier_and_rows_without_id_draw_apart(documents):
    docs = [(None if i % 3 == 0 else i, "w " * (10 if i % 2 else 40) + str(i), "en", "a") for i in range(1500)]
    out = mixing.mix(documents(docs), share=0.5, keep=("n_chars",)).collect()
    short, long = ([r["copies"] for r in out if (r["size"] > 20) == big] for big in (False, True))
    assert sum(long) / len(long) > 1.5 * sum(short) / len(short)
    no_id = [r["copies"] for r in out if r["doc_id"] is None]
    assert 0 < sum(no_id) < len(no_id) and "n_chars" in out[0].asDict()
