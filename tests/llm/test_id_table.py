"""The table of token ids holds a large vocabulary, and stays exact when it is emptied."""

import numpy as np
import public_tokenizers

from tidemark.llm import pieces

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def _texts(n, words):
    return [" ".join(f"w{chr(97 + i % 26)}{j * words + i:x}q" for i in range(words)) for j in range(n)]


def test_a_large_vocabulary_is_encoded_once(monkeypatch):
    model = pieces.PieceIds(BYTE, "<u2")
    texts = _texts(500, 1000)  # half a million distinct pieces
    first = [model.encode(texts[i:i + 50]) for i in range(0, 500, 50)]
    asked = []
    monkeypatch.setattr(model, "_learn", lambda missing: asked.extend(missing))
    assert [model.encode(texts[i:i + 50]) for i in range(0, 500, 50)] == first and not asked


def test_an_emptied_table_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(pieces, "IDS_BYTES", 1 << 15)
    model = pieces.PieceIds(BYTE, "<u2")
    texts = _texts(12, 100) * 2
    got = [model.encode(texts[i:i + 3]) for i in range(0, 24, 3)]
    want = [np.array(e.ids, "<u2").tobytes() for e in model.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [ids for part in got for ids in part] == want and len(model.kept) < 1200
