"""Near-duplicate embeddings by NN-descent.

Every vector keeps a list of its nearest known neighbours. Lists start from vectors that sort together by random hyperplane
codes, and are refined by joining the neighbours of a vector with each other. A list that holds nothing but links is
saturated: it would have to grow. Its vector is then compared with all vectors of other components, which joins those it links
to, and its component is compared as a whole, both block by block, so the longer list exists only as sums inside a task. Samples audit the recall, each vector alike; while that is short, further codes and rounds
follow, and all pairs are compared once further codes would compare as many.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.llm.common import components
from lexiloom.llm.permindex import usable
from lexiloom.session import cut, discard

THRESHOLD = 0.9
NEIGHBOURS = 8  # in a list; as many reverse neighbours join in
TABLES = 8  # orders by random codes, or log2 of the vectors if that is more
RUN = 64  # vectors that are compared in an order
SETTLED = 0.002  # a round that brings a link to a smaller share of the linked vectors is the last
AUDIT, RECALL = 4096, 0.99
SLACK = 1e-4  # single precision finds what double precision then decides
BLOCK, PARTS, MOST = 256, 64, 8192  # vectors in a block: BLOCK, more once that makes over PARTS blocks, MOST at most
EDGE = "node long, nbr long, sim float"


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest per node; the planner cuts each task's share before it shuffles."""
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "nbr"))
    return edges.withColumn("_p", place).where(F.col("_p") <= k).drop("_p")


def codes(nodes: DataFrame, dim: int, seed: int, tables: int = TABLES) -> DataFrame:
    """(t, code, mix, node, v): each vector with its hyperplane code in every order; v is the vector in single precision."""
    planes = np.random.default_rng(seed).standard_normal((dim, tables * 60)).astype(np.float32)
    weight = 1 << np.arange(59, -1, -1, dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 4096):
                part = batch.iloc[lo : lo + 4096]
                x = np.stack(part["vec"]).astype(np.float32)
                bits = (x @ planes >= 0).reshape(len(x), tables, 60)
                v = [row.tobytes() for row in x]
                for t in range(tables):
                    yield pd.DataFrame({"t": np.int32(t), "code": bits[:, t] @ weight, "node": part["node"].to_numpy(), "v": v})

    return nodes.select("node", "vec").mapInPandas(run, "t int, code long, node long, v binary").withColumn("mix", F.xxhash64("node"))


def first_lists(nodes: DataFrame, dim: int, threshold: float, k: int, seed: int, tables: int = TABLES) -> DataFrame:
    """Edges (node, nbr, sim, extra): the ``k`` nearest in each run of RUN vectors that are consecutive by code, and one more
    link (extra) to the first linked vector of the run, which ties dense groups together. Equal codes are ordered by hash,
    so a crowd of them is spread over runs and tasks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            whole = len(held) // RUN * RUN
            yield from compared(held.iloc[:whole])
            held = held.iloc[whole:]
        if held is not None:
            yield from compared(held)

    def compared(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for lo in range(0, len(rows), RUN):
            part = rows.iloc[lo : lo + RUN]
            if len(part) < 2:
                continue
            x = np.frombuffer(b"".join(part["v"]), np.float32).reshape(len(part), -1)
            ids = part["node"].to_numpy(np.int64)
            s = x @ x.T
            s[ids[:, None] == ids[None, :]] = -2  # the last vectors of one order beside the first of the next
            near = np.argsort(-s, axis=1, kind="stable")[:, :k]
            i = np.repeat(np.arange(len(ids)), near.shape[1])
            j = near.ravel()
            linked = s >= threshold - SLACK
            a = np.flatnonzero(linked.any(axis=1))
            b = linked[a].argmax(axis=1)
            ok = s[i, j] > -2
            yield pd.DataFrame({
                "node": np.concatenate([ids[i[ok]], ids[a]]), "nbr": np.concatenate([ids[j[ok]], ids[b]]),
                "sim": np.concatenate([s[i, j][ok], s[a, b]]), "extra": np.concatenate([np.zeros(ok.sum(), bool), np.ones(len(a), bool)]),
            })

    ordered = codes(nodes, dim, seed, tables).repartitionByRange("t", "code", "mix").sortWithinPartitions("t", "code", "mix")
    return ordered.select("node", "v").mapInPandas(run, EDGE + ", extra boolean")


def merged(old: DataFrame | None, found: DataFrame, k: int) -> DataFrame:
    """The lists (node, nbr, sim, new) after ``found`` edges; new: not in the ``old`` lists."""
    both = found.select("node", "nbr", "sim", F.lit(False).alias("was"))
    if old is not None:
        both = both.union(old.select("node", "nbr", "sim", F.lit(True).alias("was")))
    pairs = both.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.max("was").alias("was"))
    return cut(_top(pairs, k).select("node", "nbr", "sim", (~F.col("was")).alias("new")))


def refined(nodes: DataFrame, lists: DataFrame, threshold: float, k: int) -> DataFrame:
    """Edges between the neighbours, forward and reverse, of every vector, as far as they better a list.

    Pairs of which neither side is new have met before. Reverse neighbours are limited to ``k`` per vector, new ones first;
    a saturated list asks for nothing more.
    """
    state = lists.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("least"))
    full = F.col("n") >= k
    need = F.when(full & (F.col("least") >= threshold - SLACK), 2.0).when(full, F.col("least")).otherwise(-1.5)
    wanted = nodes.join(state, "node", "left").select(F.col("node").alias("nbr"), F.coalesce(need, F.lit(-1.5)).cast("float").alias("need"), "vec")
    back = lists.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "new")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("new"), F.xxhash64("nbr", "node")))
    back = back.withColumn("_p", place).where(F.col("_p") <= k).drop("_p")
    around = lists.select("node", "nbr", "new").union(back).groupBy("node", "nbr").agg(F.max("new").alias("new"))
    groups = (
        around.join(wanted, "nbr").groupBy("node")  # at most 2 k rows each
        .agg(F.collect_list(F.struct("nbr", "new", "need", F.col("vec").cast("array<float>").alias("vec"))).alias("b"))
        .where(F.exists("b", lambda x: x["new"])).select("b.nbr", "b.new", "b.need", F.flatten("b.vec").alias("vec"))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out_i, out_j, out_s = [], [], []
            for ids, new, wants, flat in zip(batch["nbr"], batch["new"], batch["need"], batch["vec"]):
                x = np.asarray(flat, np.float32).reshape(len(ids), -1)
                new = np.asarray(new, bool)
                s = x @ x.T
                np.fill_diagonal(s, -2)
                s[~(new[:, None] | new[None, :])] = -2
                near = np.argsort(-s, axis=1)[:, :k]
                i = np.repeat(np.arange(len(ids)), near.shape[1])
                j = near.ravel()
                better = s[i, j] > np.asarray(wants)[i]
                out_i.append(ids[i[better]])
                out_j.append(ids[j[better]])
                out_s.append(s[i, j][better])
            yield pd.DataFrame({"node": np.concatenate(out_i), "nbr": np.concatenate(out_j), "sim": np.concatenate(out_s)})

    return groups.mapInPandas(run, EDGE)


def n_linked(lists: DataFrame, threshold: float, k: int) -> tuple[int, int]:
    """Vectors with a link whose list is not saturated, and how many of them have a new link."""
    link = F.col("sim") >= threshold - SLACK
    state = lists.groupBy("node").agg(F.count_if(link).alias("links"), F.max(link & F.col("new")).alias("fresh"))
    got = state.where((F.col("links") > 0) & (F.col("links") < k)).agg(F.count(F.lit(1)).alias("n"), F.count_if("fresh").alias("new")).first()
    return got["n"], got["new"]


def descend(nodes: DataFrame, lists: DataFrame, threshold: float, k: int) -> DataFrame:
    """Rounds of neighbours-of-neighbours joins until hardly a vector outside saturated groups gets a link."""
    while True:
        better = merged(lists, refined(nodes, lists, threshold, k), k)
        discard(lists)
        lists = better
        n, new = n_linked(lists, threshold, k)
        if new <= SETTLED * n:
            return lists


def verified(nodes: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a, b), a < b, of ``edges`` whose cosine in double precision reaches the threshold."""
    pairs = edges.where(F.col("sim") >= threshold - SLACK).select(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b")).distinct()
    ends = pairs.join(nodes.select(F.col("node").alias("a"), F.col("vec").alias("x")), "a").join(nodes.select(F.col("node").alias("b"), F.col("vec").alias("y")), "b")
    product = F.aggregate(F.zip_with("x", "y", lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    return ends.where(product >= threshold).select("a", "b")


def block_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links): for members (node, part, size, m, vec) of a component ``part``, the weight m of the others that link.

    A component is dealt to blocks by hash, and every two blocks meet in one task, which returns a sum per vector.
    """
    parts = F.least(F.ceil(F.col("size") / BLOCK), F.greatest(F.lit(PARTS), F.ceil(F.col("size") / MOST))).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    met = members.withColumn("parts", parts).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = met.select("part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "m", "vec")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, m, ids, own = np.stack(rows["vec"]), rows["m"].to_numpy(), rows["node"].to_numpy(), rows["own"].to_numpy()
        left = np.flatnonzero(own == rows["i"].iloc[0])
        right = np.flatnonzero(own == rows["j"].iloc[0])
        links, same = np.zeros(len(ids), np.int64), rows["i"].iloc[0] == rows["j"].iloc[0]
        for lo in range(0, len(left), 1024):
            some = left[lo : lo + 1024]
            near = (x[some] @ x[right].T >= threshold) & (ids[some][:, None] != ids[right][None, :])
            links[some] += near @ m[right]
            if not same:
                links[right] += near.T @ m[some]
        return pd.DataFrame({"node": ids, "links": links})

    return cells.groupBy("part", "i", "j").applyInPandas(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def bridges(placed: DataFrame, asked: DataFrame, threshold: float) -> DataFrame:
    """(a, b): parts that links tie together, of ``placed`` (node, part, vec), a written table.

    Every vector of ``asked`` (node) is compared with all vectors of other parts. Both sides are dealt to blocks by hash, and
    every two blocks meet in one task, which returns a forest of the parts in it.
    """
    n, wanted = placed.count(), asked.count()
    across, down = max(1, ceil(wanted / MOST)), max(min(PARTS, ceil(n / BLOCK)), ceil(n / MOST))

    def dealt(count: int, salt: int):
        return F.pmod(F.xxhash64(F.lit(salt), "node"), F.lit(count)).cast("int")

    def each(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = placed.join(asked.select("node"), "node", "left_semi").select(dealt(across, 5).alias("i"), each(down).alias("j"), F.lit(True).alias("asks"), "part", "vec")
    right = placed.select(each(across).alias("i"), dealt(down, 6).alias("j"), F.lit(False).alias("asks"), "part", "vec")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asks, root, out = rows["asks"].to_numpy(), {}, []

        def top(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        if asks.any() and not asks.all():
            x, y = np.stack(rows["vec"][asks]), np.stack(rows["vec"][~asks])
            (p, at), (q, to) = (np.unique(rows["part"][side].to_numpy(), return_inverse=True) for side in (asks, ~asks))
            for lo in range(0, len(x), 512):
                i, j = np.nonzero(x[lo : lo + 512] @ y.T >= threshold)
                met = np.unique(at[lo + i] * len(q) + to[j])
                for a, b in zip(p[met // len(q)].tolist(), q[met % len(q)].tolist()):
                    a, b = top(a), top(b)
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        out.append((a, b))
        return pd.DataFrame(np.array(out, np.int64).reshape(-1, 2), columns=["a", "b"])

    return left.union(right).groupBy("i", "j").applyInPandas(run, "a long, b long")


def counted(nodes: DataFrame, links: DataFrame, lists: DataFrame, threshold: float, k: int, every: bool = False) -> DataFrame:
    """(node, part, links, dense): component and linked weight of every node that has a link; dense: its component was compared
    as a whole. ``every``: all pairs of vectors are compared, whatever is in the lists."""
    parts = cut(components(links).select("node", F.col("component").alias("part")))
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("nbr")).union(links.select(F.col("b").alias("node"), F.col("a").alias("nbr")))
    full = lists.where(F.col("sim") >= threshold - SLACK).groupBy("node").count().where(F.col("count") >= k)  # saturated
    full = nodes.select("node") if every else cut(full.select("node"))
    parts = tied(nodes, parts, full, threshold)  # the own component may have filled a list before a link that leaves it
    whole = cut(parts.join(full, "node", "left_semi").select("part").distinct())
    sizes = parts.join(whole, "part", "left_semi").groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    members = parts.join(sizes, "part").join(nodes.select("node", "m", "vec"), "node")
    dense = block_counts(members, threshold).withColumn("dense", F.lit(True))
    sparse = ends.join(nodes.select(F.col("node").alias("nbr"), "m"), "nbr").groupBy("node").agg(F.sum("m").alias("links"))
    sparse = sparse.join(parts.join(whole, "part", "left_anti"), "node", "left_semi").withColumn("dense", F.lit(False))
    return parts.join(dense.union(sparse), "node")


def tied(nodes: DataFrame, parts: DataFrame, asked: DataFrame, threshold: float) -> DataFrame:
    """``parts`` (node, part) after every vector of ``asked`` (node) has met those of other parts, and the unlinked ones."""
    if asked.isEmpty():
        return parts
    placed = cut(nodes.join(parts, "node", "left").select("node", F.coalesce("part", "node").alias("part"), F.col("part").isNotNull().alias("linked"), "vec"))
    ties = cut(bridges(placed, asked, threshold))
    if ties.isEmpty():
        return parts
    merge = components(ties).select(F.col("node").alias("part"), F.col("component").alias("into"))
    moved = placed.drop("vec").join(merge, "part", "left").where(F.col("linked") | F.col("into").isNotNull())
    return cut(moved.select("node", F.coalesce("into", "part").alias("part")))


def audit(nodes: DataFrame, n: int, found: DataFrame, threshold: float, most: int = AUDIT) -> float:
    """The share of its links that a vector has among ``found`` (node, links, dense), on the mean over linked vectors, each
    alike. Components compared as a whole and all other vectors are sampled apart, about ``most`` vectors of each picked by
    hash, and the lower share counts, so that neither hides what the other misses."""
    held = found.where("dense").count()
    rate = F.when(F.col("dense"), most / max(held, 1)).otherwise(most / max(n - held, 1))
    every = nodes.join(found.select("node", "dense"), "node", "left").withColumn("dense", F.coalesce("dense", F.lit(False)))
    rows = every.where(F.pmod(F.xxhash64("node", F.lit(17)), F.lit(1 << 30)) < rate * (1 << 30)).select("node", "vec").toPandas()
    if not len(rows):
        return 1.0
    ids, q = rows["node"].to_numpy(), np.stack(rows["vec"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.iloc[lo : lo + 512]
                near = np.stack(part["vec"]) @ q.T >= threshold
                near &= part["node"].to_numpy()[:, None] != ids[None, :]
                total += part["m"].to_numpy() @ near
        yield pd.DataFrame({"node": ids[total > 0], "links": total[total > 0]})

    true = nodes.select("node", "m", "vec").mapInPandas(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("want"))
    each = true.join(found.select("node", "links", "dense"), "node", "left").withColumn("got", F.least("want", F.coalesce("links", F.lit(0))))
    shares = each.groupBy(F.coalesce("dense", F.lit(False)).alias("dense")).agg(F.avg(F.col("got") / F.col("want")).alias("share")).collect()
    return min((r["share"] for r in shares), default=1.0)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS, seed: int = 3) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding; others are ignored): vec_id, n_links, component_id, kept.

    ``n_links`` is the number of other rows with a cosine of at least ``threshold`` in double precision, as found, and
    ``component_id`` the smallest vec_id reachable by links. Null, empty and zero vectors and those with null or non-finite
    components link with nothing. Equal vectors are one node of the graph, so copies are never paired; repeated rows are
    copies of each other. A null vec_id is never the smallest unless all are null. An empty table stays empty. Vectors that
    take part must have one dimension. Further codes follow until the audited recall reaches RECALL.
    """
    rows = cut(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vec")).withColumn("ok", usable("vec")).withColumn(
        "k1", F.xxhash64("vec")).withColumn("k2", F.xxhash64(F.lit(1), "vec")))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    distinct = rows.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("m"), F.any_value("vec").alias("vec"))
    unit = distinct.withColumn("_len", length).withColumn("vec", F.transform("vec", lambda x: x / F.col("_len"))).drop("_len")
    nodes = cut(unit.withColumn("node", F.monotonically_increasing_id()))
    seen = nodes.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("vec")).alias("lo"), F.max(F.size("vec")).alias("hi")).first()
    if seen["lo"] != seen["hi"]:
        raise ValueError(f"vectors of different dimensions: {seen['lo']} and {seen['hi']}")
    found = None
    if seen["n"] and seen["n"] > 1:
        lists = extras = None
        tables = max(TABLES, ceil(log2(seen["n"])))
        for attempt in count():
            every = attempt > 0 and attempt * tables * RUN >= seen["n"]  # further orders would compare as much as all pairs do
            if not every:
                start = cut(first_lists(nodes, seen["hi"], threshold, k, seed + attempt, tables))
                lists = descend(nodes, merged(lists, start.where("not extra"), k), threshold, k)
                more = start.where("extra").select("node", "nbr", "sim")
                extras = more if extras is None else extras.union(more)
                links = cut(verified(nodes, lists.select("node", "nbr", "sim").union(extras), threshold))
            found = cut(counted(nodes, links, lists, threshold, k, every))
            if every or audit(nodes, seen["n"], found, threshold) >= RECALL:
                break
    if found is None:
        found = nodes.select("node", F.col("node").alias("part"), F.lit(0).cast("long").alias("links"))
    linked = nodes.select("node", "k1", "k2", "first", "m").join(found, "node", "left").withColumn("part", F.coalesce("part", "node"))
    named = linked.groupBy("part").agg(F.min("first").alias("component_id"))
    by_vector = linked.join(named, "part").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    used = rows.where("ok").select("vec_id", "k1", "k2").join(by_vector, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    unused = rows.where("not ok").select("vec_id", F.lit(0).cast("long"), "vec_id")
    every = used.union(unused)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

