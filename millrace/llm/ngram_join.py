"""Operator 9: Jaccard join on word shingles by groups that share a prefix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import Ordered
from ..session import pin
from .common import joined_bytes, mix, mix2, pieces
from .components import components
from .rolling import LOWER, spans, windows, words

#: Words in a shingle, and the similarity from which two documents are linked, in hundredths, unless a caller says otherwise.
SHINGLE, PERCENT = 5, 80
#: Counters of the sketch that finds frequent shingles, and their blocks: 4 MB, whatever the corpus.
COUNTERS, BLOCKS = 1 << 20, 64
#: 64-bit words of a set's odd sketch: bit i is set when an odd number of shingles fall on i.
ODD = [f"o{i}" for i in range(8)]
#: Partners that a group meets before components are known; all others follow when they still matter.
FIRST = 2
#: Another order of the lists is tried while the last one added a link to so many.
PAYS = 20
#: Lists that a class carries along to tell on which of them it met another one before.
CARRIED = 16
CHUNK = 2 << 20


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ascending, in one array, and where each text starts, with the end."""
    raw, at = joined_bytes([(t or "").encode() for t in texts])
    _, _, doc, word = words(raw, at, LOWER)
    first = np.arange(max(0, len(word) - size + 1))
    first = first[doc[first] == doc[first + size - 1]] if len(first) else first
    name, _ = windows(word, first, size)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    few = np.flatnonzero((np.diff(edges) > 0) & (np.diff(edges) < size))
    whole = mix(spans(word, edges[few], edges[few + 1]) + np.diff(edges)[few].astype(np.uint64)) if len(few) else np.zeros(0, np.uint64)
    owner = np.concatenate([doc[first], few])
    name = np.concatenate([name, whole])
    order = np.lexsort((name, owner))
    owner, name = owner[order], name[order]
    new = np.ones(len(name), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])
    return name[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Of n shingles, so many first ones that two sets similar enough share one of them in any order."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def spare(n, percent: int = PERCENT):
    """How many entries more than its prefix a set of n shingles puts on lists: as many again, if it has them."""
    p = prefix_size(n, percent)
    return np.minimum(p, n - p)


def dropped(n, percent: int = PERCENT):
    """Of how many of its entries a set may be relieved, the longest lists first.

    With as many spare entries on either side two similar sets share that many
    and one more, so one is left however both are relieved, as long as lists
    are in one order. The partner may be smaller: its spare entries count.
    """
    return spare((percent * n + 99) // 100, percent)


def _digest(names: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set of names, whatever their order."""
    a = np.append(np.uint64(0), np.cumsum(mix(names), dtype=np.uint64))
    b = np.append(np.uint64(0), np.cumsum(mix(names + np.uint64(77)), dtype=np.uint64))
    return mix2(a[at[1:]] - a[at[:-1]] + n.astype(np.uint64), b[at[1:]] - b[at[:-1]])


def _odd_sketch(names: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of bits per set. Of two sets the bits that differ are at most their differing shingles, as
    shared ones cancel out: a bound that rules out pairs without their sets, however large those are."""
    bits = 64 * len(ODD)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    count = np.bincount(owner * bits + (mix(names + np.uint64(5)) & np.uint64(bits - 1)).astype(np.int64), minlength=(len(at) - 1) * bits)
    return np.packbits((count & 1).astype(bool).reshape(-1, bits), axis=1).view(np.int64)


def _prefixes(names: np.ndarray, at: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set, spare ones included, rare ones before frequent ones, and where each set's start."""
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    often = rank[(names & np.uint64(COUNTERS - 1)).astype(np.int64)]
    order = np.lexsort((names, often, owner))
    place = np.arange(len(names)) - at[owner]
    size = prefix_size(n, percent) + spare(n, percent)
    return names[order][place < size[owner]], np.append(0, np.cumsum(size))


class JaccardJoin:
    """The steps of the join over one table; ``links`` and ``classes`` are its results.

    Documents with one shingle set are one class. Classes with one prefix and
    one size are one group, and only groups enter the inverted lists. A pair
    of groups on one list is a candidate; it is expanded to members, and
    members are verified on their whole sets.

    A set puts twice its prefix on lists and is then taken off the longest of
    them, which similar sets cannot all share by chance.

    Lists are not multiplied out at once. First every group meets its
    neighbour on each list, so a list of any length gives fewer pairs than
    entries; the verified ones form components, whose entries meet their next
    neighbours of other components, each time in another order of the lists,
    until few are links. Then only entries of different components still meet,
    those of a list's largest component only others, and a pair once, however
    many lists it shares. No link between documents of different components is
    lost, and copies, near copies and passages that a third of all rows share
    stay linear. What remains are pairs whose sketches are near the limit and
    that no chain of links joins. Shingles are compared by 64-bit names.
    """

    def __init__(
        self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT, name_col: str | None = None
    ):
        """``docs`` carries the string column ``name_col`` along, when there is one, as ``_name``."""
        self.size, self.percent = size, percent
        self.kind = df.schema[id_col].dataType.simpleString()
        self.names = ["_name"] if name_col else []
        self.rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(name_col).alias(c) for c in self.names])
        self.rank = self.rows.sparkSession.sparkContext.broadcast(self._frequent())
        self.docs = pin(self._described(), "sets")
        # sets of one size and digest are one class; its document with the least id stands for it, and all have the same sketch
        self.classes = self.docs.where("n > 0").groupBy("cid").agg(F.min("_id").alias("_id"), F.min("n").alias("n"), F.min("gid").alias("gid"), *[F.min(c).alias(c) for c in ODD])

    def _texts(self, turn, schema: str) -> DataFrame:
        return self.rows.mapInArrow(turn, schema)

    def _frequent(self) -> np.ndarray:
        """A rank per counter: 0 unless its shingles are far more frequent than chance fills a counter."""
        size = self.size

        def turn(batches):
            from pyspark import TaskContext

            count = np.zeros(COUNTERS, np.int64)
            for part in pieces(batches, ["_id", "_text"], "_text", CHUNK):
                names, _ = shingles(part["_text"].to_pylist(), size)
                np.add.at(count, (names & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
            if count.any():
                blocks = [x.tobytes() for x in np.split(count, BLOCKS)]
                task = np.full(BLOCKS, TaskContext.get().partitionId() % 256, np.int32)
                yield pa.RecordBatch.from_pydict({"block": np.arange(BLOCKS, dtype=np.int32), "salt": task, "n": blocks})

        def add(t: pa.Table) -> pa.Table:
            total = np.zeros(COUNTERS // BLOCKS, np.int64)
            for block in t.column("n"):
                total += np.frombuffer(block.as_buffer(), np.int64)
            return t.slice(0, 1).set_column(2, "n", pa.array([total.tobytes()], pa.binary()))

        schema = "block int, salt int, n binary"
        # in two steps, so that no task adds up the blocks of all tasks
        salted = self._texts(turn, schema).groupBy("block", "salt").applyInArrow(add, schema)
        count = np.zeros((BLOCKS, COUNTERS // BLOCKS))
        for row in salted.groupBy("block").applyInArrow(add, schema).collect():
            count[row.block] = np.frombuffer(row.n, np.int64)
        count = count.ravel()
        middle = np.median(count)
        excess = np.maximum(count - middle - 4 * np.sqrt(middle + 1) - 4, 0)
        return np.ceil(np.log2(1 + excess)).astype(np.int8)

    def _described(self) -> DataFrame:
        size, percent, rank, carried = self.size, self.percent, self.rank, self.names

        def turn(batches):
            for part in pieces(batches, ["_id", "_text", *carried], "_text", CHUNK):
                names, at = shingles(part["_text"].to_pylist(), size)
                n = np.diff(at)
                first, starts = _prefixes(names, at, rank.value, percent)
                columns = {"_id": part["_id"], **{c: part[c] for c in carried}, "n": pa.array(n, pa.int32())}
                columns |= {"cid": _digest(names, at, n).view(np.int64), "gid": _digest(first, starts, n).view(np.int64)}
                odd = _odd_sketch(names, at)
                columns |= {c: np.ascontiguousarray(odd[:, i]) for i, c in enumerate(ODD)}
                yield pa.RecordBatch.from_pydict(columns)

        named = "".join(f"{c} string, " for c in carried)
        return self._texts(turn, f"_id {self.kind}, {named}n int, cid long, gid long, " + ", ".join(f"{c} long" for c in ODD))

    def _lists(self) -> DataFrame:
        """Entries ``token``, ``n``, ``gid`` of all groups; a task names each group once."""
        size, percent, rank = self.size, self.percent, self.rank

        def turn(batches):
            seen: set[int] = set()
            for part in pieces(batches, ["_id", "_text"], "_text", CHUNK):
                names, at = shingles(part["_text"].to_pylist(), size)
                n = np.diff(at)
                first, starts = _prefixes(names, at, rank.value, percent)
                gid = _digest(first, starts, n).view(np.int64)
                fresh = np.zeros(len(n), bool)
                for i, g in enumerate(gid.tolist()):
                    if g not in seen:
                        seen.add(g)
                        fresh[i] = True
                length = np.diff(starts)
                use = np.repeat(fresh, length)
                yield pa.RecordBatch.from_pydict(
                    {
                        "token": first[use].view(np.int64),
                        "n": pa.array(np.repeat(n, length)[use], pa.int32()),
                        "gid": np.repeat(gid, length)[use],
                    }
                )

        return self._texts(turn, "token long, n int, gid long")

    def _near(self, small: str, large: str):
        return F.col(small).cast("long") * 100 >= F.col(large).cast("long") * self.percent

    def links(self) -> DataFrame:
        """Verified pairs ``a``, ``b`` of classes that connect every pair of similar classes."""
        first, later, _ = self._rounds()
        return first.union(later)

    def roots(self) -> DataFrame:
        """``node`` and ``root`` of every class: the components of the first links, then those of the components."""
        _, later, member = self._rounds()
        of = lambda c: member.select(F.col("cid").alias(c), F.col("root").alias(f"root_{c}"))
        between = later.join(of("a"), "a").join(of("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()
        merged = pin(components(pin(between, "links")), "roots").select(F.col("node").alias("root"), F.col("root").alias("_to"))
        return member.join(merged, "root", "left").select(F.col("cid").alias("node"), F.coalesce("_to", "root").alias("root"))

    def _rounds(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The links of first partners, the classes with the components these form, and the links between those."""
        along = Window.partitionBy("token").orderBy("n", F.xxhash64("gid", "token"), "gid")
        entries = self._lists().select("*", F.lag("gid").over(along).alias("before"), F.lag("n").over(along).alias("n_before"), F.lead("gid").over(along).alias("after"))
        # lists of one group link nothing; a group that several tasks named stands beside itself
        shared = pin(entries.where("before <> gid or after <> gid").drop("after"), "lists")
        classes = pin(self.classes, "classes")
        heads = classes.groupBy("gid").agg(F.min("cid").alias("head"), F.count(F.lit(1)).alias("members"))
        # groups that are alike are neighbours on many lists, others by chance on one
        beside = shared.where("before <> gid").where(self._near("n_before", "n")).groupBy("gid", "before").agg(F.count(F.lit(1)).alias("times"))
        place = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("times"), "before"))
        pairs = beside.where("times > 1").withColumn("place", place).where(F.col("place") <= FIRST).select(F.col("gid").alias("g"), F.col("before").alias("h"))
        of = lambda c, to: heads.select(F.col("gid").alias(c), F.col("head").alias(to))
        groups = pairs.join(of("g", "x"), "g").join(of("h", "y"), "h").select("x", "y")
        inside = classes.join(heads.where("members > 1"), "gid").where("cid <> head").select(F.col("head").alias("x"), F.col("cid").alias("y"))
        first = pin(self._ordered(groups.union(inside)).distinct(), "candidates")
        found = pin(self._verified(first, classes), "links")

        roots = components(found)
        member = classes.join(roots, classes["cid"] == roots["node"], "left").select("cid", "n", "gid", F.coalesce("root", "cid").alias("root"), *ODD)
        member = pin(member, "members")
        relieved = pin(self._relieved(shared.select("token", "n", "gid").distinct()), "entries")
        lists = pin(self._different(relieved), "entries")
        tried, links, turn, total = first, found, 0, found.count()
        while True:
            # entries that stand together on a list and may be similar: never more pairs than entries
            pairs = self._ordered(self._beside(self._mixed(lists, member), turn)).distinct().join(tried, ["x", "y"], "left_anti")
            pairs = pin(pairs, "candidates")
            more = pin(self._verified(pairs, classes), "links")
            new, turn, tried = more.count(), turn + 1, tried.union(pairs)
            if new:
                links, total = links.union(more), total + new
                member = self._contracted(member, more)
            if new == 0 or new * PAYS < total:
                break
        # two queries: adaptive execution plans all of one again after each of its stages
        across = pin(self._across(pin(self._mixed(lists, member), "entries"), "token").distinct(), "candidates")
        beside = pin(self._across(pin(member.join(heads.where("members > 1").select("gid"), "gid", "left_semi"), "members"), "gid"), "candidates")
        rest = self._ordered(across.union(beside)).distinct().join(tried, ["x", "y"], "left_anti")
        return links, pin(self._verified(pin(rest, "candidates"), classes), "links"), member

    @staticmethod
    def _mixed(lists: DataFrame, member: DataFrame) -> DataFrame:
        """Entries of the lists on which classes of different components stand."""
        entries = lists.join(member, "gid")
        mixed = entries.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
        return entries.join(mixed, "token", "left_semi")

    def _beside(self, entries: DataFrame, turn: int = 0) -> DataFrame:
        """Neighbours on each list, by size, that belong to different components and may be similar.

        Later turns order by sizes stretched at random by less than similar sets may differ in size, so that
        others become neighbours. A list is sorted over several tasks when it is long."""
        columns = ("cid", "n", "root", *ODD)
        stretch = F.pmod(F.xxhash64("cid", "token", F.lit(turn)), F.lit(1 << 20)) * ((100 / self.percent - 1) / (1 << 20) if turn else 0.0)
        drawn = entries.withColumns({"_size": F.col("n") * (1 + stretch), "_turn": F.xxhash64("cid", "token")})
        placed = Ordered(drawn, ["token"], ["_size", "_turn", "cid"])
        met = placed.previous("_b", F.struct(*columns)).result().where("_b is not null")
        met = met.select(*[F.col(c).alias(f"{c}_b") for c in columns], *[F.col(f"_b.{c}").alias(f"{c}_a") for c in columns])
        return self._alike(met.where("root_a <> root_b")).select(F.col("cid_a").alias("x"), F.col("cid_b").alias("y"))

    @staticmethod
    def _contracted(member: DataFrame, links: DataFrame) -> DataFrame:
        """Members with the components that further links form of theirs."""
        of = lambda c: member.select(F.col("cid").alias(c), F.col("root").alias(f"root_{c}"))
        between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()
        merged = components(pin(between, "links")).select(F.col("node").alias("root"), F.col("root").alias("_to"))
        out = member.join(merged, "root", "left").withColumn("root", F.coalesce("_to", "root")).drop("_to")
        return pin(out.select(*member.columns), "members")

    def _relieved(self, entries: DataFrame) -> DataFrame:
        """Entries without those on the longest lists of each group, as many as leave every similar pair one in common."""
        length = entries.groupBy("token").agg(F.count(F.lit(1)).alias("length"))
        p = self.percent
        m = f"(({p}L * n + 99) div 100)"  # the smallest partner
        prefix = f"({m} - ({p}L * {m} + 99) div 100 + 1)"
        # no more rows than the set has shingles
        place = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("length"), F.desc("token")))
        kept = entries.join(length, "token").withColumn("place", place).where(f"place > least({prefix}, {m} - {prefix})")
        return kept.select("token", "gid")

    @staticmethod
    def _different(entries: DataFrame) -> DataFrame:
        """One list of those that hold the same groups, as the shingles of a shared passage do; by 128-bit names."""
        name = [F.bit_xor(F.xxhash64(F.lit(i), "gid")).alias(f"name{i}") for i in (1, 2)]
        lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("length"), *name).where("length > 1")
        one = lists.groupBy("length", "name1", "name2").agg(F.min("token").alias("token"))
        return entries.join(one.select("token"), "token", "left_semi")

    def _overlap(self, n_a: str, n_b: str) -> str:
        """The shingles that sets of these sizes share at least when they are similar."""
        return f"((({n_a} + {n_b}) * {self.percent}L + {99 + self.percent}) div {100 + self.percent})"

    def _across(self, entries: DataFrame, on: str) -> DataFrame:
        """Pairs of classes on one list that belong to different components and may be similar.

        One side leaves out the component that most of a list belongs to. A pair is met on the first list it
        shares; ``CARRIED`` lists are compared, so only long sets with few lists in common may meet twice."""
        columns = ("cid", "n", "root", *ODD)
        shares = entries.groupBy(on, "root").agg(F.count(F.lit(1)).alias("_k"))
        most = shares.groupBy(on).agg(F.max_by("root", F.struct("_k", "root")).alias("most"))
        first = entries.groupBy("cid").agg(F.slice(F.sort_array(F.collect_list(on)), 1, CARRIED).alias("on"))
        known = entries.join(first, "cid")
        side = lambda s: [F.col(c).alias(c + s) for c in (*columns, "on")]
        few = known.join(most, on).where("root <> most").select(on, "most", *side("_a"))
        met = few.join(known.select(on, *side("_b")), on).where("root_a <> root_b and (root_b = most or cid_a < cid_b)")
        met = self._alike(met).where(f"array_min(array_append(array_intersect(on_a, on_b), {on})) = {on}")
        return met.select(F.col("cid_a").alias("x"), F.col("cid_b").alias("y"))

    def _alike(self, met: DataFrame) -> DataFrame:
        """Pairs whose sizes and odd sketches leave it open that they are similar."""
        differ = " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in ODD)
        sizes = f"least(n_a, n_b) * 100L >= greatest(n_a, n_b) * {self.percent}L"
        return met.where(sizes).where(f"{differ} <= n_a + n_b - 2 * {self._overlap('n_a', 'n_b')}")

    @staticmethod
    def _ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))

    def _verified(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar enough. Only texts of candidates become sets."""
        size, percent = self.size, self.percent
        wanted = pairs.select(F.col("x").alias("cid")).union(pairs.select(F.col("y").alias("cid"))).distinct()
        # written first, so that few of them are known to be few and all texts need not be shuffled to meet them
        texts = pin(classes.join(wanted, "cid", "left_semi").select(F.col("_id").alias("_rep"), "cid"), "wanted")
        chosen = self.rows.join(texts, F.col("_id").eqNullSafe(F.col("_rep"))).select("cid", "_text")

        def sets(batches):
            for part in pieces(batches, ["cid", "_text"], "_text", CHUNK):
                names, at = shingles(part["_text"].to_pylist(), size)
                cid = _digest(names, at, np.diff(at)).view(np.int64)
                # rows that share an id may hold other texts
                own = cid == part["cid"].to_numpy()
                raw = [names[a:b].tobytes() for a, b, o in zip(at[:-1].tolist(), at[1:].tolist(), own.tolist()) if o]
                yield pa.RecordBatch.from_pydict({"cid": cid[own], "names": pa.array(raw, pa.binary())})

        whole = chosen.mapInArrow(sets, "cid long, names binary")
        side = lambda c: whole.select(F.col("cid").alias(c), F.col("names").alias(f"names_{c}"))

        def compare(batches):
            for b in batches:
                keep = []
                for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    if len(x) > len(y):
                        x, y = y, x
                    same = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                    keep.append(100 * same >= percent * (len(x) + len(y) - same))
                yield b.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

        met = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "names_x", "names_y")
        return met.mapInArrow(compare, "x long, y long").select(F.col("x").alias("a"), F.col("y").alias("b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the least id reachable by links, itself included.

    Texts with fewer words than a shingle have their whole sequence as one;
    NULL texts and texts without words have none and are linked with nothing.
    Rows with equal sets are linked, rows that share an id as well. A NULL id
    is returned as such and never is a component's id while another is there.
    An empty table gives an empty one; other columns are not read.
    """
    join = JaccardJoin(df, id_col, text_col, size, percent)
    roots = pin(join.roots(), "roots")
    docs = join.docs.join(roots, join.docs["cid"] == roots["node"], "left").select("_id", "n", F.coalesce("root", "cid").alias("root"))
    # a key of its own: both sides are then shuffled for this join alone, and Spark can split a hot component
    named = docs.withColumn("_root", F.col("root").cast("string"))
    least = docs.where("n > 0").groupBy("root").agg(F.min("_id").alias("least")).select(F.col("root").cast("string").alias("_root"), "least")
    named = named.join(least, "_root", "left")
    own = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("_id"))
    return named.select(F.col("_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def survivors(df: DataFrame, name_col: str, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``name_col``, a string that names a row, of one row per component and of all rows without words.

    A component's row is the one with the least id, NULL after all others, then the least name. Components
    are those of the links, also when an id stands in several of them.
    """
    join = JaccardJoin(df, id_col, text_col, size, percent, name_col)
    rank = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_name").alias("name"))
    # copies become one row before they meet their root
    classes = join.docs.where("n > 0").groupBy("cid").agg(F.min(rank).alias("best"))
    roots = pin(join.roots(), "roots")
    rooted = classes.join(roots, classes["cid"] == roots["node"], "left").select("best", F.coalesce("root", "cid").alias("root"))
    best = rooted.groupBy("root").agg(F.min("best").alias("best"))
    return best.select(F.col("best.name").alias(name_col)).union(join.docs.where("n = 0").select(F.col("_name").alias(name_col))).distinct()
