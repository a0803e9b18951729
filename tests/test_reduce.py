import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from logweft.streaming.reduce import COUNTS, Tail, _share_function, merge_shares


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 2), st.integers(1, 9)), max_size=12), st.integers(1, 7),
       st.randoms())
def test_a_tail_is_the_end_of_all_rows(parts, limit, rng):
    rows, place = [], 0
    for segment, offset, size in parts:
        rows += [(segment, offset, place + i, f"{place + i}") for i in range(size)]
        place += size
    tail, pieces = Tail(limit), [rows[i:i + 3] for i in range(0, len(rows), 3)]
    rng.shuffle(pieces)
    for piece in pieces:
        for segment, offset, number, raw in piece:
            tail.add(segment, offset, [(number, raw)])
    assert tail.rows() == sorted(rows)[-limit:]
    assert len(tail.stretches) <= limit + 1


def test_shares_of_many_tasks_add_up():
    rng = random.Random(3)
    lines = [("a", f"seg{i // 50:03d}", 0, f"v{rng.randint(0, 4)}", f"line {i}", 1, int(rng.random() < 0.3), 0, 0, 7)
             for i in range(4000)]
    frame = pd.DataFrame(lines, columns=["source", "segment", "offset", "service", "raw", *COUNTS, "clock"])
    tasks = [frame[frame["segment"] == s] for s in frame["segment"].unique()]
    rng.shuffle(tasks)
    # Some tasks read two segments, the later one first.
    tasks = [pd.concat([tasks[0], tasks[1]]), *tasks[2:]]
    shares = [share for task in tasks for share in _share_function(60)(iter([task.iloc[:20], task.iloc[:0], task.iloc[20:]]))]
    assert max(map(len, shares)) <= 60
    whole = merge_shares(iter(shares), 60)
    assert (whole.n, whole.errors, whole.clock) == (4000, frame["errors"].sum(), 7)
    assert dict(whole.service_errors) == frame.groupby("service")["errors"].sum().to_dict()
    assert whole.tail == frame["raw"].tolist()[-60:]
