"""Pages of short files are handed on together, all of them and in order."""

from __future__ import annotations

import pandas as pd

from docketry.operators import documents


class Files:
    """Takes the function that a task runs."""

    def select(self, *_):
        return self

    def mapInPandas(self, function, schema):  # noqa: N802 - Spark's name
        return function


def test_short_files_share_a_frame_and_a_long_one_leaves_at_once(monkeypatch):
    monkeypatch.setattr(documents, "HELD", 10_000)
    decode = documents.decode_pages(Files(), documents.utf8_pages)
    contents = [b"a\fb", b"", b"\xff", b"x" * 20_000, b"c", b"d\fe\ff"]
    batches = [pd.DataFrame({"seq": range(3), "content": contents[:3]}), pd.DataFrame({"seq": range(3, 6), "content": contents[3:]})]
    frames = list(decode(iter(batches)))
    assert [len(f) for f in frames] == [5, 4]
    rows = pd.concat(frames)
    assert list(rows["seq"]) == [0, 0, 1, 2, 3, 4, 5, 5, 5]
    assert [None if pd.isna(n) else n for n in rows["page_no"]] == [1, 2, 1, None, 1, 1, 1, 2, 3]
    assert list(rows["text"].fillna("-")) == ["a", "b", "", "-", "x" * 20_000, "c", "d", "e", "f"]
    assert rows["reason"].notna().tolist() == [n == 3 for n in range(9)]
    assert list(decode(iter([]))) == []
