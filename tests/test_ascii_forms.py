"""The ASCII forms of a batch: few Python strings at a time, and none of texts that are ASCII already."""

import pyarrow as pa

from textloom.functions import encoding


def test_ascii_texts_do_not_reach_python(monkeypatch):
    seen, whole = [], encoding.to_ascii
    monkeypatch.setattr(encoding, "to_ascii", lambda t: seen.append(t) or whole(t))
    texts = [None, "", "plain", "café"] * 300 + ["ß\U0001f600"]
    got = encoding._ascii_forms.func(pa.array(texts))
    assert got.to_pylist() == [None, "", "plain", "cafe"] * 300 + ["ss"]
    assert len(seen) == 301 and encoding._ascii_forms.func(pa.array(["a", None])).to_pylist() == ["a", None]
    assert encoding._ascii_forms.func(pa.array([], pa.string())).to_pylist() == []
