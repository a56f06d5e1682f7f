"""Rings of accounts that share attributes, as connected components.

The graph is bipartite: accounts and the attribute values (IP, address, device ...) that
at least two accounts have.  A value is a hub of its accounts, so a value shared by a
million accounts is a star of a million edges, never their pairs.  Components come from
rounds of hooking and shortcutting over tables: every account and every value takes the
smallest label of its neighbours, then of its label's label, until nothing changes.
Each round is an aggregate (partial before the shuffle) and equi-joins, and is cut from
its lineage by a checkpoint in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..session import ensure_checkpoint_dir

c = F.col


def shared_values(attributes: DataFrame, min_members: int = 2) -> DataFrame:
    """(kind, value, account, members): distinct pairs of the values that at least ``min_members`` accounts have."""
    pairs = attributes.select("kind", "value", "account").dropna().distinct()
    sizes = pairs.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("members")).filter(c("members") >= min_members)
    return pairs.join(sizes, ["kind", "value"])


def components(edges: DataFrame) -> DataFrame:
    """(account, ring): the smallest account that can be reached over ``edges`` (hub, account)."""
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select("hub", "account").distinct().checkpoint()
    labels = edges.select("account", c("account").alias("ring")).distinct()
    while True:
        # a hub's label is the smallest of its accounts', an account's the smallest of its hubs'
        hubs = edges.join(labels, "account").groupBy("hub").agg(F.min("ring").alias("low"))
        hooked = edges.join(hubs, "hub").groupBy("account").agg(F.min("low").alias("low"))
        # shortcut: an old label's own account may have a smaller one by now, which all that carry the label take
        moved = labels.join(hooked, "account").groupBy("ring").agg(F.min("low").alias("to"))
        own = hooked.select(c("account").alias("to"), c("low").alias("far"))
        jump = moved.join(own, "to", "left").select("ring", F.least("to", F.coalesce("far", "to")).alias("to"))
        new = labels.join(jump, "ring").select("account", c("to").alias("ring"), (c("to") != c("ring")).alias("changed")).checkpoint()
        labels = new.select("account", "ring")
        if new.filter("changed").isEmpty():
            return labels


def account_rings(attributes: DataFrame, min_members: int = 2) -> DataFrame:
    """Rings over all kinds of attributes (kind, value, account): per account its ring (the smallest
    account of it), the ring's size, and the number of its values that others share."""
    shared = shared_values(attributes, min_members)
    hub = F.concat_ws("\u0000", "kind", "value")
    rings = components(shared.select(hub.alias("hub"), "account"))
    sizes = rings.groupBy("ring").agg(F.count(F.lit(1)).alias("ring_size"))
    own = shared.groupBy("account").agg(F.count(F.lit(1)).alias("shared_values"))
    return rings.join(sizes, "ring").join(own, "account").select("account", "ring", "ring_size", "shared_values")


def type_sets(alerts: DataFrame, types: list[str], account: str = "caller_number", prefix: bool = True) -> DataFrame:
    """(kind, value, account): the set of fraud types of each caller as a bit mask (bit i: ``types[i]``), so equal sets are equal values."""
    is_type = (lambda t: c("alert_type").startswith(t)) if prefix else (lambda t: c("alert_type") == t)
    bits = [F.max(is_type(t).cast("long")) * F.lit(1 << i) for i, t in enumerate(types)]
    mask = alerts.groupBy(account).agg(reduce(lambda a, b: a + b, bits).alias("mask")).filter("mask > 0")
    return mask.select(F.lit("types").alias("kind"), c("mask").cast("string").alias("value"), c(account).alias("account"))
