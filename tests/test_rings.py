"""Rings of accounts (J10) against union-find, takeovers across midnight."""

import datetime as dt
import random

from ringfence.operators.joins import takeover_correlation
from ringfence.operators.rings import account_rings, shared_values, type_sets


def test_rings_are_connected_components(spark):
    rnd = random.Random(4)
    rows = [("ip", f"i{rnd.randrange(60)}", f"a{rnd.randrange(90)}") for _ in range(70)]
    rows += [("address", f"i{rnd.randrange(60)}", f"a{rnd.randrange(90)}") for _ in range(40)]  # the same texts are other values
    rows += [("ip", f"chain{i}", f"c{i + j}") for i in range(40) for j in range(2)]  # a long chain
    rows += [("ip", "hub", f"h{i}") for i in range(300)] + [("ip", None, "a1"), ("ip", "hub", None), ("ip", "alone", "z")] + rows[:5]
    found = {r.account: (r.ring, r.ring_size, r.shared_values) for r in account_rings(spark.createDataFrame(rows, "kind string, value string, account string")).collect()}
    members = {}
    for kind, value, account in rows:
        if value is not None and account is not None:
            members.setdefault((kind, value), set()).add(account)
    shared = {k: m for k, m in members.items() if len(m) > 1}
    root = {a: a for m in shared.values() for a in m}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for m in shared.values():
        for a in m:
            x, y = sorted((find(a), find(min(m))))
            root[y] = x
    want = {}
    for a in root:
        want.setdefault(find(a), set()).add(a)
    assert found == {a: (min(m), len(m), sum(a in s for s in shared.values())) for m in want.values() for a in m}
    assert "z" not in found and len(want) > 3


def test_equal_sets_of_types(spark):
    rows = [("a", "SIM Box x"), ("a", "IRSF y"), ("b", "IRSF z"), ("b", "SIM Box"), ("c", "IRSF"), ("d", "other"), ("e", None), (None, "IRSF")]
    sets = type_sets(spark.createDataFrame(rows, "caller_number string, alert_type string"), ["SIM Box", "IRSF"])
    assert sorted((r.account, r.value, r.members) for r in shared_values(sets).collect()) == [("a", "3", 2), ("b", "3", 2)]


def test_takeover_within_24_hours_crosses_midnight(spark):
    at = lambda day, hour: dt.datetime(2024, 1, day, hour)
    rows = [(1, at(1, 22), 1, "Login", "A"), (1, at(1, 23), 2, "Device_Change", "A"), (1, at(2, 1), 3, "Login", "B"), (1, at(2, 3), 4, "Password_Reset", "B"),
            (2, at(1, 1), 5, "Login", "A"), (2, at(1, 2), 6, "Device_Change", "B"), (2, at(2, 3), 7, "Password_Reset", "B"),  # 25 hours
            (3, at(1, 1), 8, "SIM_Swap_Request", "A"), (3, at(1, 23), 9, "Password_Reset", "A"),
            (4, at(1, 23), 10, "SIM_Swap_Request", "A"), (4, at(2, 1), 11, "Password_Reset", "A")]
    got = takeover_correlation(spark.createDataFrame(rows, "customer_id long, ts timestamp_ntz, event_id long, event_type string, geo_location string")).collect()
    assert sorted((r.customer_id, r.day.day, r.sim_swap_takeover, r.device_takeover) for r in got) == [(1, 2, False, True), (3, 1, True, False)]
