"""The windows against a plain simulation with a dictionary."""

import random

import pytest

from tidewire.operators.matching import match, match_files

SCHEMA = "seq long, time long, qr int, id int, qname string, qtype int, client string, port int, file string"


def simulate(events, files, timeout):
    """(pairs, response only, expired) over files in order, and what stays pending."""
    pending, transfers, out = {}, {}, []
    for name in files:
        last = None
        for seq, time, qr, ident, qname, qtype, client, port, _ in (e for e in events if e[8] == name):
            last, key, flow = time, (ident, qname, client, port), (ident, client, port)
            if qr == 0:
                if qtype in (251, 252):
                    transfers[flow] = 0
                pending[key] = (pending[key][0] if key in pending else time, seq)
                continue
            if flow in transfers:
                if transfers[flow]:
                    continue
                transfers[flow] = 1
            if key in pending:
                out.append((pending.pop(key)[1], seq, False))
            elif qname is not None:
                out.append((None, seq, False))
        for key in [k for k, v in pending.items() if last is not None and v[0] < last - timeout]:
            first, seq = pending.pop(key)
            if key[1] is not None:
                out.append((seq, None, True))
    return out, {v[1] for v in pending.values()}


def events(n, files, seed):
    r, out, time = random.Random(seed), [], 0
    for i in range(n):
        time += r.randint(0, 400)
        out.append((i, time, int(r.random() < 0.5), r.randint(0, 2), r.choice(["a.", "b.", None]), r.choice([1, 1, 1, 252, 251]), r.choice(["x", "y"]), r.randint(1, 2), files[i * len(files) // n]))
    return out


def rows(joined):
    return sorted(((r["request"] and r["request"]["seq"], r["response"] and r["response"]["seq"], r["expired"]) for r in joined.collect()), key=str)


@pytest.mark.parametrize(("seed", "timeout"), [(1, 2000), (2, 0), (3, 100_000)])
def test_one_file(spark, seed, timeout):
    data = events(600, ["f"], seed)
    joined, pending = match(spark.createDataFrame(data, SCHEMA), timeout)
    want, left = simulate(data, ["f"], timeout)
    assert rows(joined) == sorted(want, key=str)
    assert {r["seq"] for r in pending.collect()} == left


def test_pending_queries_cross_files(spark):
    files = ["f1", "f2", "f3"]
    data = events(450, files, 7)
    joined, pending = match_files(spark.createDataFrame(data, SCHEMA), "file", files, 3000)
    want, left = simulate(data, files, 3000)
    assert rows(joined) == sorted(want, key=str)
    assert {r["seq"] for r in pending.collect()} == left


@pytest.mark.parametrize(("n", "seed", "timeout"), [(12, 1, 600), (30, 2, 0), (30, 3, 2500), (500, 4, 900)])
def test_many_files_in_one_plan(spark, n, seed, timeout):
    """Against the dictionary; some files have no messages, and an earlier run left queries."""
    names = [f"f{i:03d}" for i in range(n)]
    data = [(*e[:8], names[min(n - 1, i * n // 900 + (i % 2 if i % 7 == 0 else 0))]) for i, e in enumerate(events(900, ["x"], seed))]
    data.sort(key=lambda e: (e[8], e[0]))
    if seed % 2:  # one run, with zone transfers, which are followed over the run
        joined, rest = match_files(spark.createDataFrame(data, SCHEMA), "file", names, timeout)
        got = rows(joined)
    else:
        data, cut = [(*e[:5], 1, *e[6:]) for e in data], names[n // 3]
        early, late = [e for e in data if e[8] < cut], [e for e in data if e[8] >= cut]
        one, left = match_files(spark.createDataFrame(early, SCHEMA), "file", [x for x in names if x < cut], timeout)
        two, rest = match_files(spark.createDataFrame(late, SCHEMA), "file", [x for x in names if x >= cut], timeout, left)
        got = rows(one) + rows(two)
    want, stays = simulate(data, names, timeout)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r["seq"] for r in rest.collect()} == stays


def test_sequences(spark):
    def run(*steps, timeout=2000):
        data = [(i, t, qr, 1, name, 1, "c", 5, "f") for i, (qr, name, t) in enumerate(steps)]
        return rows(match(spark.createDataFrame(data, SCHEMA), timeout)[0])

    assert run((0, "a", 0), (1, "a", 5)) == [(0, 1, False)]
    assert run((1, "a", 0)) == [(None, 0, False)]
    assert run((1, None, 0)) == []
    assert run((0, None, 0), (1, None, 1)) == [(0, 1, False)]
    assert run((0, "a", 0), (0, "a", 1), (1, "a", 2)) == [(1, 2, False)]
    assert run((0, "a", 0), (1, "a", 1), (1, "a", 2)) == sorted([(0, 1, False), (None, 2, False)], key=str)
    # the first query's time decides, though the second one is given out
    assert run((0, "a", 0), (0, "a", 2500), (1, "b", 2600)) == sorted([(1, None, True), (None, 2, False)], key=str)


def test_empty(spark):
    joined, pending = match(spark.createDataFrame([], SCHEMA))
    assert joined.count() == 0 and pending.count() == 0
