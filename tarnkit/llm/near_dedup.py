"""Near-duplicate documents by an inverted join of MinHash signature coordinates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tarnkit.llm.components import SHORT, components, gathered, stored
from tarnkit.llm.keyfilter import key_bits, maybe_in
from tarnkit.llm.workers import lean, slices

WORDS = 5
#: Percent of shared shingles that links two documents.
SIMILARITY = 75
#: Coordinates of a signature, and how many two documents must share to be compared. A pair at the similarity
#: threshold shares 24 on average; fewer than 10 happens once in about 29 million such pairs.
COORDINATES, MATCHES = 32, 10
#: Coordinates of which eight bits are kept, the first COORDINATES among them, and how many must agree before sets are fetched: of a pair at the threshold 72
#: agree on average, fewer than LIKELY once in 26 million pairs.
WIDE, LIKELY = 96, 48
#: Bits of the filter of values that more than one class has: 4 MB.
SHARED_BITS = 24
#: Posting lists up to the first length are joined with themselves, up to the second compared whole; from longer ones pivots are taken, first PIVOTS from each.
SHORT_LIST, LONG_LIST, PIVOTS = 48, 4096, 8
#: Shingles of the pivots, and about those of the members, that a task compares with each other.
BLOCK_SHINGLES, MEMBER_SHINGLES = 1 << 20, 1 << 22
#: Shingles of sets that are sent to every executor at most: 2 MB.
BROADCAST_SHINGLES = 1 << 18
NO_ID = -(1 << 63)  # stands for a null id

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and where each text's begin (one entry more than texts)."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = pc.ascii_split_whitespace(trimmed)
    coded = pc.dictionary_encode(words.flatten())
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    of_word = hashes[coded.indices.to_numpy()] if len(hashes) else np.zeros(0, np.uint64)
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    empty = pc.equal(trimmed, "").to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    full = max(len(of_word) - WORDS + 1, 0)
    rolling = of_word[:full].copy()
    for k in range(1, WORDS):
        rolling = _mixed(rolling * _MIX + of_word[k : full + k])
    sets, sizes = [], []
    for n, end, none in zip(lengths, ends, empty):
        at = end - n
        if none:
            found = rolling[:0]
        elif n >= WORDS:
            found = np.unique(rolling[at : end - WORDS + 1])
        else:
            whole = np.uint64(n)
            for h in of_word[at:end]:
                whole = _mixed(np.array([whole]) * _MIX + h)[0]
            found = np.array([whole], np.uint64)
        sets.append(found)
        sizes.append(len(found))
    return (np.concatenate(sets) if sets else rolling[:0]), np.r_[0, np.cumsum(sizes)].astype(np.int64)


def _class_id(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def signatures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", more: tuple[Column, ...] = ()) -> DataFrame:
    """Per row: doc, cls (128-bit hash of its set of shingles), n_shingles, signature and wide (both null without shingles; ``wide``
    has eight bits of each of WIDE coordinates, eight in a number), and ``more``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = np.random.default_rng(7).integers(1, 1 << 63, (2, WIDE), np.uint64)
        for batch in batches:
            for part in slices(batch, 512):
                flat, starts = _shingle_sets(part.column(1))
                sizes = np.diff(starts)
                some = np.flatnonzero(sizes)
                signature = np.zeros((len(some), WIDE), np.int32)
                for k in range(WIDE):
                    values = ((flat * (seeds[0, k] | np.uint64(1)) + seeds[1, k]) >> np.uint64(32)).astype(np.uint32)
                    if len(some):
                        signature[:, k] = np.minimum.reduceat(values, starts[:-1][some]).view(np.int32)
                lists = []
                for values in (signature[:, :COORDINATES], signature.astype(np.uint8).view(np.int64)):
                    offsets = np.r_[0, np.cumsum((sizes > 0) * values.shape[1])].astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()), mask=pa.array(sizes == 0)))
                classes = [_class_id(flat[a:b]) for a, b in zip(starts, starts[1:])]
                columns = [part.column(0), pa.array(classes, pa.binary()), pa.array(sizes), *lists, *part.columns[2:]]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "cls", "n_shingles", "signature", "wide", *part.schema.names[2:]])

    rows = docs.select(_doc(doc_id), F.col(f"`{text}`").cast("string"), *more)
    schema = T.StructType([*T._parse_datatype_string("doc bigint, cls binary, n_shingles bigint, signature array<int>, wide array<bigint>"), *rows.schema[2:]])
    return rows.mapInArrow(lean(sign), schema)


def text_tag(text: str = "text") -> Column:
    """128 bits that tell texts apart; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))).alias("tag")


def _doc(doc_id: str) -> Column:
    return F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NO_ID)).alias("doc")


def _sets_of(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str) -> DataFrame:
    """cid, shingles for the classes ``wanted`` (cls, cid, doc): the texts of the documents they are named after, shingled again. Each task gives a class once; rows that repeat one
    document may have several tasks give it."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[bytes] = set()
        for batch in batches:
            for part in slices(batch, 512):
                flat, starts = _shingle_sets(part.column(1))
                classes = [_class_id(flat[a:b]) for a, b in zip(starts, starts[1:])]
                new = []
                for cls in classes:
                    new.append(cls not in given)
                    given.add(cls)
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), lists], ["cls", "shingles"]).filter(pa.array(new, pa.bool_()))

    wanted = stored(wanted, "wanted", slim=True)
    rows = docs.select(_doc(doc_id), F.col(f"`{text}`").cast("string"))
    held = maybe_in(rows, F.xxhash64("doc"), key_bits(wanted, F.xxhash64("doc")))
    shingled = held.mapInArrow(lean(shingle), "cls binary, shingles array<bigint>")
    few = F.broadcast if wanted.count() <= SHORT else lambda names: names
    return shingled.join(few(wanted.select("cls", "cid")), "cls").select("cid", "shingles")


#: The bits of the first COORDINATES.
SKETCH = [f"s{k}" for k in range(COORDINATES // 8)]


def _agreeing(ones: list[Column], others: list[Column]) -> Column:
    """Coordinates whose bits agree: all that two signatures share, and of the others one in 256."""
    unlike = F.lit(0)
    for one, other in zip(ones, others):
        bits = one.bitwiseXOR(other)
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift)).bitwiseAND(F.lit(mask))
        unlike = unlike + F.bit_count(bits)
    return 8 * len(ones) - unlike


def _matches(a: str, b: str) -> Column:
    return _agreeing([F.col(f"{a}{name}") for name in SKETCH], [F.col(f"{b}{name}") for name in SKETCH])


def postings(classes: DataFrame) -> DataFrame:
    """A row for each class that may have a partner: cid, n_shingles, popularity, its sketch and ``keys``, the coordinate-value pairs it is posted under.

    A pair of classes that shares MATCHES of its coordinates shares one of the first COORDINATES - MATCHES + 1 in any common
    order. The order is from rare to frequent, so a passage that very many documents hold does not bring them together;
    values that no other class has come first and are not posted at all.
    """
    elements = classes.select("cid", F.posexplode("signature").alias("at", "value")).select(F.xxhash64("at", "value").alias("key"), "cid")
    shared = stored(elements.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared", slim=True)
    # most values of one class alone stay where they are
    likely = maybe_in(elements, F.col("key"), key_bits(shared, F.col("key"), SHARED_BITS), SHARED_BITS)
    # 20 bits of the frequency before 43 of the hash
    place = F.call_function("shiftleft", F.least(F.col("n"), F.lit((1 << 20) - 1)), F.lit(43)) + F.shiftrightunsigned("key", 21)
    placed = likely.join(shared, "key").select("cid", F.struct(place.alias("place"), "key", "n").alias("e"))
    listed = placed.groupBy("cid").agg(F.array_sort(F.collect_list("e")).alias("keys")).filter(F.size("keys") >= MATCHES)
    posted = listed.select(
        "cid",
        F.aggregate("keys", F.lit(0).cast("bigint"), lambda total, e: total + e["n"]).alias("popularity"),
        F.transform(F.slice("keys", F.lit(1), F.size("keys") - (MATCHES - 1)), lambda e: e["key"]).alias("keys"),
    )
    return posted.join(classes.select("cid", "n_shingles", *[F.element_at("wide", k + 1).alias(name) for k, name in enumerate(SKETCH)]), "cid")


def _may_link(a: str, b: str) -> Column:
    """Whether sizes and shared coordinates of two rows allow a link."""
    na, nb = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
    return (100 * F.least(na, nb) >= SIMILARITY * F.greatest(na, nb)) & (_matches(a, b) >= MATCHES)


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are similar enough.

    Their wide sketches rule out most of the others before any set is fetched. A set is then shuffled once to meet all pairs it is second in. The first ones are broadcast if
    they are few (pivots are), up to BROADCAST_SHINGLES in all; beyond that a second join brings them."""
    pairs = stored(pairs, "pairs", slim=True)
    few = F.broadcast if pairs.count() <= SHORT else lambda names: names
    for side in ("a", "b"):
        pairs = few(pairs).join(classes.select(F.col("cid").alias(side), F.col("wide").alias(f"wide_{side}")), side)
    words = [[F.element_at(f"wide_{side}", k + 1) for k in range(WIDE // 8)] for side in ("a", "b")]
    pairs = stored(pairs.filter(_agreeing(*words) >= LIKELY).select("a", "b"), "likely", slim=True)
    few = F.broadcast if pairs.count() <= SHORT else lambda names: names
    asked = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    sets = stored(_sets_of(docs, classes.select("cls", "cid", "doc").join(few(asked), "cid", "left_semi"), text, doc_id), "sets")
    firsts = sets.join(few(pairs.select("a").distinct()), F.col("cid") == F.col("a"), "left_semi")
    firsts = firsts.select(F.col("cid").alias("a"), F.col("shingles").alias("set1")).dropDuplicates(["a"])
    small = (firsts.agg(F.sum(F.size("set1"))).first()[0] or 0) <= BROADCAST_SHINGLES
    both = few(pairs).join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set2")), "b").join(
        F.broadcast(firsts) if small else firsts, "a"
    )
    inter = F.size(F.array_intersect("set1", "set2"))
    union = F.size("set1") + F.size("set2") - inter
    return both.filter(100 * inter >= SIMILARITY * union).select("a", "b")


class _Index:
    """The sets of some pivots, turned over: which of them hold a shingle."""

    def __init__(self, nodes: np.ndarray, flat: np.ndarray, starts: np.ndarray):
        self.nodes, self.sizes = nodes, np.diff(starts)
        order = np.argsort(flat, kind="stable")
        self.owners = np.repeat(np.arange(len(nodes)), self.sizes)[order]
        self.shingles, self.starts = np.unique(flat[order], return_index=True)
        self.ends = np.r_[self.starts[1:], len(flat)].astype(np.int64)

    def linked(self, node: int, shingles: np.ndarray) -> np.ndarray:
        """Numbers of the other pivots that are similar enough to a set."""
        at = np.searchsorted(self.shingles, shingles)
        at = at[(at < len(self.shingles)) & (self.shingles[np.minimum(at, len(self.shingles) - 1)] == shingles)]
        lengths = self.ends[at] - self.starts[at]
        before = np.cumsum(lengths) - lengths
        places = np.repeat(self.starts[at] - before, lengths) + np.arange(lengths.sum())
        shared = np.bincount(self.owners[places], minlength=len(self.nodes))
        union = self.sizes + len(shingles) - shared
        return np.flatnonzero((100 * shared >= SIMILARITY * union) & (self.nodes != node))


def _pivot_links(lists: DataFrame, chosen: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges that connect what links between pivots and members of lists do, by full sets.

    Pivots are dealt to blocks of about BLOCK_SHINGLES, and a member meets the blocks that hold pivots of its lists. A task turns over the
    pivots of one block and counts the shingles each of its members shares with all of them at once; members are dealt on to as many tasks as
    leave MEMBER_SHINGLES to each. A link is passed on only if it connects what the task's links so far don't: no more rows than
    members and pivots. Sets stay on executors."""
    # the names of so few members are broadcast rather than all sets shuffled
    few = F.broadcast if lists.count() <= SHORT else lambda names: names
    pivots = stored(sets.join(few(chosen.select("cid").distinct()), "cid").select("cid", "shingles"), "pivot-sets")
    total = pivots.agg(F.sum(F.size("shingles"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_SHINGLES))
    block = F.pmod(F.xxhash64("cid"), F.lit(blocks)).alias("block")
    members = lists.select("key", "cid", "n_shingles")
    if blocks > 1:
        members = members.join(chosen.select("key", block).distinct(), "key")
    else:
        members = members.withColumn("block", F.lit(0).cast("bigint"))
    members = stored(members.select("cid", "n_shingles", "block").distinct(), "members", slim=True)
    most = members.groupBy("block").agg(F.sum("n_shingles").alias("n")).agg(F.max("n")).first()[0] or 0
    salts = max(-(-most // MEMBER_SHINGLES), -(-lists.sparkSession.sparkContext.defaultParallelism // blocks))
    salt = F.pmod(F.xxhash64("cid"), F.lit(salts)).cast("int").alias("salt")
    full = sets.join(few(members.select("cid", "block", salt)), "cid").select("block", "salt", "cid", "shingles")
    dealt = pivots.select(block, F.explode(F.sequence(F.lit(0), F.lit(int(salts) - 1))).alias("salt"), "cid", "shingles")
    both = full.groupBy("block", "salt").cogroup(dealt.groupBy("block", "salt"))
    return both.applyInArrow(_connect, "a bigint, b bigint")


def _connect(members: pa.Table, pivots: pa.Table) -> pa.Table:
    index = _Index(*_flat(pivots))
    component = np.arange(len(index.nodes))
    ends, out = [], []
    nodes, flat, starts = _flat(members)
    for node, start, end in zip(nodes.tolist(), starts, starts[1:]):
        linked = index.linked(node, flat[start:end]) if len(index.nodes) else []
        if not len(linked):
            continue
        roots, first = np.unique(component[linked], return_index=True)
        out += index.nodes[linked[first]].tolist()
        ends += [node] * len(roots)
        if len(roots) > 1:
            component[np.isin(component, roots)] = roots[0]
    return pa.table({"a": pa.array(ends, pa.int64()), "b": pa.array(out, pa.int64())})


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes, all their shingles in a row, and where each one's begin (one entry more than classes)."""
    shingles = table.column("shingles")
    sizes = pc.list_value_length(shingles).to_numpy()
    return table.column("cid").to_numpy(), pc.list_flatten(shingles).to_numpy(), np.r_[0, np.cumsum(sizes)].astype(np.int64)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    A-Z are lower-cased and words are what white space parts. A document's set holds its distinct five-word shingles; with fewer words the
    whole sequence is the only one; without words or text it is empty and linked with nothing. Two documents are linked
    if their sets' similarity is at least SIMILARITY percent; component_id is the smallest id reachable, kept whether
    that is the row's own. Rows of one id are one document; null ids are one document with the smallest id and component_id null.

    Equal sets are one class, so copies never meet each other. Classes are posted under the coordinate-value pairs
    of their signatures (:func:`postings`); in a list, those that share enough coordinates are compared on full sets (:func:`_labels`).
    """
    rows = stored(signatures(docs, text, doc_id), "signatures")
    classes = rows.filter("n_shingles > 0").groupBy("cls", "n_shingles", "signature", "wide").agg(F.min("doc").alias("doc"))
    classes = _numbered(classes)
    reached = _reached(classes, _labels(docs, classes, text, doc_id, _one_id(rows, classes)), "doc")
    found = rows.select("doc", "cls", "n_shingles").join(reached.select("cls", F.col("first").alias("label")), "cls", "left")
    own = F.coalesce("label", "doc")
    return found.select(
        _id("doc").alias("doc_id"), "n_shingles", _id(own).alias("component_id"), (F.col("doc") == own).alias("kept")
    )


def near_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc, tag (:func:`text_tag`), n_rows, kept: a row for each id and text, where every such pair is a document of its own.

    Links are those of :func:`near_duplicates`, but an id ties nothing together: neither the texts of a repeated id nor those without one.
    Of each component the document with the smallest id (null is the smallest) and tag is kept, and all without shingles are."""
    rows = stored(signatures(docs, text, doc_id, (text_tag(text),)), "signatures")
    classes = rows.filter("n_shingles > 0").groupBy("cls", "n_shingles", "signature", "wide").agg(F.min(F.struct("doc", "tag")).alias("own"))
    classes = _numbered(classes.withColumn("doc", F.col("own.doc")))
    reached = _reached(classes, _labels(docs, classes, text, doc_id), "own").select("first").distinct()
    firsts = reached.select("first.doc", "first.tag", F.lit(True).alias("is_first"))
    each = rows.groupBy("doc", "tag").agg(F.count(F.lit(1)).alias("n_rows"), F.max("n_shingles").alias("n_shingles"))
    kept = (F.col("n_shingles") == 0) | F.col("is_first").isNotNull()
    return each.join(firsts, ["doc", "tag"], "left").select("doc", "tag", "n_rows", kept.alias("kept"))


def _numbered(classes: DataFrame) -> DataFrame:
    """Classes with a number of their own, ``cid``; once written, the numbers stay."""
    return stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")


def _reached(classes: DataFrame, labels: DataFrame, own: str) -> DataFrame:
    """cls, first: the smallest ``own`` of all classes in the component of each class."""
    named = classes.select("cls", "cid", own).join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    firsts = named.groupBy("label").agg(F.min(own).alias("first"))
    return named.select("cls", "label").join(firsts, "label").select("cls", "first")


def _labels(docs: DataFrame, classes: DataFrame, text: str, doc_id: str, known: DataFrame | None = None) -> DataFrame:
    """node, label for the numbers of ``classes`` that links, or the ``known`` edges, connect with others.

    First each class meets, of the most popular members of its lists, the one it shares most coordinates with: so groups of near copies, however large, become one
    component by one comparison for each class. Lists whose members are then all in one component are closed, as no pair is left in them that could
    change anything. In the others the classes of different components are compared: short lists are joined with themselves, and pairs that share enough coordinates go on. In
    lists of up to LONG_LIST members all are compared with all by what shingles they share, without a row for each pair (:func:`_pivot_links`). From a
    longer list a few pivots at a time are compared with its members and then leave it; each round takes eight times as many pivots, until no list
    has two components: nothing is capped or dropped.
    """
    posted = stored(postings(classes), "postings", slim=True)
    edges = _links(_best_pivots(posted), classes, docs, text, doc_id)
    edges = stored(edges.unionByName(known) if known is not None else edges, "links", slim=True)
    labels = stored(components(edges), "labels", slim=True)
    named = _labelled(posted, gathered(labels))
    members = named.select(*[c for c in named.columns if c != "keys"], F.explode("keys").alias("key"))
    spread = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n_list"))
    open_ = stored(members.join(spread.filter("low != high").select("key", "n_list"), "key"), "open", slim=True)
    short = open_.filter(F.col("n_list") <= SHORT_LIST).select("key", "cid", "label", "n_shingles", *SKETCH)
    right = short.toDF(*[c if c == "key" else f"r_{c}" for c in short.columns])
    apart = (F.col("cid") < F.col("r_cid")) & (F.col("label") != F.col("r_label"))
    pairs = short.join(right, "key").filter(apart & _may_link("", "r_")).select(F.col("cid").alias("a"), F.col("r_cid").alias("b"))
    labels = _joined(labels, stored(_links(pairs.distinct(), classes, docs, text, doc_id), "links", slim=True))
    lists = open_.filter(F.col("n_list") > SHORT_LIST).drop("label")
    if lists.isEmpty():
        return labels
    lists = gathered(stored(_undecided(lists, gathered(labels)), "lists", slim=True))
    asked = lists.select("cid").distinct()
    sets = stored(_sets_of(docs, classes.select("cls", "cid", "doc").join(asked, "cid", "left_semi"), text, doc_id), "sets")
    middle = lists.filter(F.col("n_list") <= LONG_LIST)
    labels = _joined(labels, stored(_pivot_links(middle, middle, sets), "links", slim=True))
    lists = gathered(stored(_undecided(lists.filter(F.col("n_list") > LONG_LIST).drop("label", "n_label"), gathered(labels)), "lists", slim=True))
    pivots = PIVOTS
    while not lists.isEmpty():
        chosen = gathered(stored(_pivots(lists, pivots), "pivots", slim=True))
        labels = _joined(labels, stored(_pivot_links(lists, chosen, sets), "links", slim=True))
        lists = stored(lists.join(chosen.select("key", "cid"), ["key", "cid"], "left_anti").drop("label", "n_label"), "left", slim=True)
        lists = gathered(stored(_undecided(lists, gathered(labels)), "lists", slim=True))
        pivots *= 8
    return labels


def _best_pivots(posted: DataFrame) -> DataFrame:
    """Pairs a, b: class b and, of the most popular members of its lists, the one that shares most coordinates with it, if it shares enough."""
    members = posted.select(F.explode("keys").alias("key"), "cid", "popularity", "n_shingles", *SKETCH)
    first = F.max(F.struct("popularity", "cid", "n_shingles", *SKETCH)).alias("first")
    firsts = members.groupBy("key").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "first")
    met = members.join(firsts, "key").filter((F.col("cid") != F.col("first.cid")) & _may_link("", "first."))
    return met.groupBy(F.col("cid").alias("b")).agg(F.max(F.struct(_matches("", "first."), F.col("first.cid").alias("a"))).alias("m")).select("m.a", "b")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    named = rows.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    return named.withColumn("label", F.coalesce("label", "cid"))


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after more edges."""
    if found.isEmpty():
        return labels
    stars = labels.filter("node != label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return stored(components(stars.unionByName(found)), "labels", slim=True)


def _one_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the classes of rows that share an id."""
    placed = rows.select("doc", "cls").join(classes.select("cls", "cid"), "cls").select("doc", "cid").distinct()
    least = placed.groupBy("doc").agg(F.min("cid").alias("a"), F.max("cid").alias("most")).filter("a != most")
    return placed.join(least, "doc").filter("a != cid").select("a", F.col("cid").alias("b"))


def _undecided(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Lists with more than one component, each member with its label and that label's members in the list."""
    named = _labelled(lists, labels)
    counts = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n_label"))
    several = counts.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    return named.join(several.select("key"), "key", "left_semi").join(counts, ["key", "label"])


def _pivots(lists: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` members of each list: those of its smallest components first, and of these the ones whose coordinate
    values are the most common, as the text that many others were copied from has those."""
    order = W.partitionBy("key").orderBy("n_label", F.desc("popularity"), "cid")
    return lists.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= most).drop("turn")


def _id(value) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value != NO_ID, value)
