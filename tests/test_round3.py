"""What the third round of findings asked for."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import ranges


def stamp(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def test_moments_inside_an_interval(spark):
    """Stretches without length are paired where they lie inside, on request only."""
    a = spark.createDataFrame([(1, k, stamp(x), stamp(y)) for k, x, y in [(0, 1, 1), (1, 2, 2), (2, 5, 5), (3, 0, 3), (4, 3, 3), (5, 9, 9)]], "g int, a int, a0 timestamp_ntz, a1 timestamp_ntz")
    b = spark.createDataFrame([(1, stamp(1), stamp(5)), (1, stamp(2.5), stamp(8))], "g int, b0 timestamp_ntz, b1 timestamp_ntz")
    pairs = lambda **more: sorted((r["a"], r["b0"] == stamp(1)) for r in ranges.overlap_join(a, b, "g", ("a0", "a1"), ("b0", "b1"), **more).collect())
    assert pairs() == [(3, False), (3, True)]
    assert pairs(instants=True) == [(1, True), (2, False), (3, False), (3, True), (4, False), (4, True)]


def test_a_block_of_ticks_is_linear_work():
    """Three hours of ten samples a second come out of one timer: every tick shows its span, in little time."""
    import time

    import numpy as np
    from millrace.streaming.state import Ticks

    class Held:
        def __init__(self):
            self.rows = []

        def get(self):
            return self.rows

        def exists(self):
            return bool(self.rows)

        def update(self, row):
            self.rows = [row]

        put = lambda self, rows: setattr(self, "rows", rows)
        appendValue = lambda self, row: self.rows.append(row)
        clear = lambda self: self.rows.clear()

    class At:
        def __init__(self, ms):
            self.getExpiryTimeInMs = self.getCurrentWatermarkInMs = lambda: ms

    work = Ticks(300_000, 2_000, 12 * 900_000)
    work._handle = type("Handle", (), {"registerTimer": lambda self, ms: None, "deleteTimer": lambda self, ms: None})()
    work._samples, work._next = Held(), Held()
    us = np.arange(108_000) * 100_000
    import pandas as pd

    list(work.handleInputRows(("a", 0), iter([pd.DataFrame({"at_us": us, "number": us * 1.0})]), None))
    began, rows, per = time.time(), 0, {}
    for frame in work.handleExpiredTimer(("a", 0), At(10**9), At(0)):
        rows += len(frame)
        for tick, n in frame["tick_us"].value_counts().items():
            per[tick] = per.get(tick, 0) + n
    assert rows == sum(int(((us <= t) & (us > t - 300_000_000)).sum()) for t in range(0, 108_000 * 100_000, 2_000_000)) and len(per) == 5_400
    assert time.time() - began < 30 and not work._samples.rows


def test_a_file_is_not_held_as_text(spark):
    """Reading a long file takes little memory beside its bytes; line ends inside quotes, marks and missing texts stay as they were."""
    import tracemalloc

    import pyarrow as pa
    from millrace.sources import files

    class Caught:
        select = lambda self, *c: self
        mapInArrow = lambda self, work, schema: work

    work = files.files_to_rows(Caught(), ["A", "B"])
    odd = 'A,B\n"x\r\ny",é世\n1,2,3\r\n,z'
    batch = lambda *texts: pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(len(texts))]), pa.array(texts, pa.string())], ["file", "content"])
    got = [r for part in work(iter([batch(odd, None, "")])) for r in part.to_pylist()]
    assert got == [{"A": "x\r\ny", "B": "é世", "file": "0"}, {"A": None, "B": "z", "file": "0"}]
    long = batch("A,B\n" + "some text,some more of it\n" * 2_000_000)
    tracemalloc.start()
    rows = sum(part.num_rows for part in work(iter([long])))
    assert rows == 2_000_000 and tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()


def test_sheet_texts_are_compared_by_id(spark):
    """Rows whose subjects or entities differ only before cleaning are duplicates, as are rows with nulls; other columns still tell rows apart."""
    from millrace.plans import linkage

    rows = [("C1", "Café Inc", "RE: x"), ("C1", "Café Inc", "re: x"), ("C1", "Café Inc", None), ("C1", "Café Inc", None), ("C2", None, None), ("C2", None, None), (None, None, None)]
    raw = spark.createDataFrame([(*r, dt.date(2020, 1, 1), "2019-05-06") for r in rows], "CLAIM_NUMBER string, ENTITY string, subject string, received date, VALUATION_DATE string")
    got = linkage.tag_sheets(raw, "subject", "received", F.lit("2020-02-02"))
    assert got.columns == linkage.SCHEMAS["claim_sheet"].names
    shown = [(r["CLAIM_NUMBER"], r["ENTITY"], r["EMAIL_FULL_SUBJECT_LINE"], r["VALUATION_DATE"]) for r in got.collect()]
    day = dt.date(2019, 5, 6)
    assert sorted(shown, key=str) == sorted([("C1", "Cafe Inc", "RE: X", day), ("C1", "Cafe Inc", None, day), ("C2", None, None, day), (None, None, None, day)], key=str)


def test_numbering_and_elements_are_kept_small(spark, monkeypatch):
    """Numbering and pivots keep Parquet, no row checkpoints, and a short list of elements is broadcast before the values move."""
    from millrace.operators import aggregates, ranking
    from pyspark.sql import DataFrame

    def refuse(*args, **kwargs):
        raise AssertionError("rows are checkpointed")

    monkeypatch.setattr(DataFrame, "checkpoint", refuse)
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    assert ranking.number_rows(df, [F.col("x").asc()]).filter("row_no != x + 1").count() == 0
    vals = spark.range(2000).select((F.col("id") / 7).cast("long").alias("e"), (F.col("id") % 7).alias("k"), F.lit(1.0).alias("v"))
    elems = vals.select("k", F.col("k").alias("n")).distinct()
    out = aggregates.eav_pivot(vals, elems, "e", "k", "n", "v", {"one": 1})
    assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString() and out.count() == 286


def test_devices_are_counted_without_a_table_of_them(spark):
    """Reach of own and all viewing equals counting by hand, nulls and repeats included, and no aggregate is kept by device."""
    from millrace.plans import audience

    rows = [
        ("s", 1, "A", 10), ("s", 1, "A", 5), ("s", 1, "B", 7), ("s", 2, "A", None), ("s", 2, None, 3), ("s", 2, None, 4), ("s", None, "A", 9), ("s", None, "C", 2),
        ("t", 1, "B", 1), ("t", 3, "D", None), (None, 4, "A", 6), ("s", 5, "ANYTV", 8), ("s", 1, "A", 1),
    ]
    viewing = spark.createDataFrame([(*r, k % 2) for k, r in enumerate(rows)], "state string, device int, channel string, seconds int, slot int")
    cells = spark.createDataFrame([("s", 10, 5), ("t", 4, 2)], "state string, universe int, active_pop int")

    def by_hand(any_of):
        seen = {}
        for state, device, channel, seconds, slot in viewing.collect():
            # A channel that bears the label of all viewing is counted apart from it, and both are added up.
            for label, part in [(channel, 0), ("ANYTV", 1)][:1 + any_of]:
                devices, watch = seen.setdefault((state, label, slot), (set(), []))
                devices |= {(device, part)} if device is not None else set()
                watch += [seconds] if seconds is not None else []
        return {k: (len(d), sum(w) if w else None) for k, (d, w) in seen.items()}

    for any_of in (False, True):
        out = audience.weighted_cells(
            viewing, cells.drop("active_pop"), cells.drop("universe"), ["state"], ["channel", "slot"], "device", "seconds", any_of="channel" if any_of else None
        )
        got = out.collect()
        assert {(r["state"], r["channel"], r["slot"]): (r["raw_reach"], r["raw_watchtime"]) for r in got} == by_hand(any_of) and len(got) == len(by_hand(any_of))
        assert {r["reach"] for r in got if r["state"] == "s"} == {r["raw_reach"] * 2 for r in got if r["state"] == "s"}
        aggregates = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate(" in line]
        assert aggregates and not any("device#" in line.split("functions")[0] for line in aggregates)


def test_modelling_a_batch_is_light_and_equals_a_plain_loop():
    """Scores equal those of one decision after another with updates after every chunk, and a batch holds few values per decision."""
    import tracemalloc

    import numpy as np
    from millrace.llm import mixing as m

    rng = np.random.default_rng(7)
    tree = m.huffman(rng.integers(1, 1000, 256))
    odds = rng.normal(0, 1, (m.PREDICTORS, 1 << m.SLOT_BITS)).astype(np.float32)
    odds[:, ::3] = 0
    bounds = np.r_[0, np.cumsum([1, 700, 3, 40, 1500])]
    data = rng.integers(97, 123, bounds[-1]).astype(np.uint8)
    data[bounds[1:] - 1] = m.END
    own, shift = m.contexts(data, bounds), np.uint32(32 - m.SLOT_BITS)
    steps = tree.path.view(m.STEP)
    costs = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        cost, made = 0.0, 0
        segment = None
        for at in range(a, b):
            if made // m.SEGMENT != segment:  # everything starts anew with the first byte after each multiple
                segment, weights, cells, inside = made // m.SEGMENT, np.full((m.GATES, m.PREDICTORS), m.START_WEIGHT), 1 / (1 + np.exp(-(np.arange(m.MAP_CELLS) - m.MAP_CELLS / 2 + 0.5))), []
            for step in steps[tree.start[data[at]]:][:tree.length[data[at]]]:
                x = [float(odds[k][(own[k][at:at + 1] * m.CONTEXT_CODE + step["node"] >> shift)[0]]) for k in range(m.PREDICTORS)]
                if not inside:
                    gate, before = int(x[-2] != 0) + 2 * int(x[-1] != 0), cells.copy()
                    w, grow = weights[gate].copy(), np.zeros(m.PREDICTORS)
                mixed = float(np.clip(np.dot(w, x), -11.5, 11.5))
                p, cell = 1 / (1 + np.exp(-mixed)), m.MAP_CELLS // 2 + int(np.floor(mixed))
                chance = 0.75 * p + 0.25 * before[cell]
                cost += np.log10(max(chance if step["bit"] else 1 - chance, 1e-7))
                grow += (step["bit"] - p) * m.WEIGHT_RATE * np.array(x)
                cells[cell] = before[cell] + (step["bit"] - before[cell]) * m.MAP_RATE
                inside.append(1)
                if len(inside) == m.CHUNK:
                    weights[gate] += grow
                    inside = []
                made += 1
        costs.append(cost)
    assert np.allclose(m.bit_costs(data, bounds, tree, odds), costs, rtol=2e-3)

    data = rng.integers(97, 123, 1 << 18).astype(np.uint8)
    bounds = np.arange(0, len(data) + 1, 1024)
    tracemalloc.start()
    m.bit_costs(data, bounds, tree, odds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 * tree.length[data].sum()
