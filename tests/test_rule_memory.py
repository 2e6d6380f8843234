"""What the search for indexed pieces holds at a time."""

import pyarrow as pa

from skylag.operators import rule_tables as R


def test_found_pieces_leave_with_their_texts_not_with_the_batch():
    texts = [f"{i:07d}" * 3000 for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"_id": pa.array(range(200), pa.int64()), "_text": texts})
    out = list(R._gram_scan((2, 4), None, R.BUCKETS)(iter([batch])))
    # all pieces were held for the whole batch, 8 MB of text, and came as one
    assert len(out) > 10 and max(len(set(b.column(0).to_pylist())) for b in out) <= 13
    got = [x for b in out for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    expected = {
        (i, int.from_bytes(t[k : k + n].encode(), "little") | n << 56)
        for i, t in enumerate(texts) for n in (2, 4) for k in range(8)
    }
    assert len(got) == len(set(got)) and set(got) == expected
