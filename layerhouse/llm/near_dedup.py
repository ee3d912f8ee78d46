"""Near duplicates: fast similarity sketches, banding, exact verification, connected groups.

A text's set holds its distinct five-word shingles as 64-bit hashes.  Its sketch has ``BANDS * ROWS``
coordinates, filled by rounds of hashed bin placement: in round ``i`` every shingle goes to one bin
with a value that is larger than all values of earlier rounds, and after as many rounds as there are
bins each shingle is put into one given bin per round, so every bin is filled after at most twice as
many rounds as bins.  Long texts fill all bins in a few rounds, and equal coordinates estimate the
similarity as sharply as independent MinHashes do.

Texts that agree in all rows of a band share a bucket.  Two texts of similarity 0.75 share no bucket
with a probability of ``(1 - 0.75 ** ROWS) ** BANDS``, 3e-7.  Only groups are wanted, so copies need
not be compared with each other: first every text is compared, on the full sets, with the one it meets
most often among the smallest identifiers of its buckets, and what is linked becomes one group.  That
closes a bucket of copies.  In a bucket that still holds several groups, every member outside the
largest group meets all members of other groups: by their sketches, whose estimate has to reach
``LIKELY`` (a similarity of 0.75 falls short with a probability of 1e-8), and then on the full sets,
until the groups are connected.  Large buckets are dealt in blocks, and pairs never leave their task.
Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from layerhouse.llm.inputs import slices, texts
from layerhouse.session import release, scratch, written

WORDS, BANDS, ROWS = 5, 56, 5
BINS = BANDS * ROWS

#: Similarity from which texts are linked, in hundredths.
SIMILAR = 75

#: Members that one copy of a centre's set is sent for, and pairs whose sets meet in one call.
PER_COPY, PER_CALL = 200, 1000

#: Share of equal coordinates from which two sketches are taken to the full sets.
LIKELY = 0.6

#: Members of a bucket in one block, and rows whose sketches meet in one call.
BLOCK, PER_SIEVE = 1024, 8_000

#: Odd constants that mix 64-bit values (fixed values: golden ratio and two of SplitMix64).
GOLDEN, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix(values: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser; ``salt`` chooses the function."""
    x = values + np.uint64((salt + 1) * GOLDEN & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(31)
    return x


def shingle_sets(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, concatenated and ordered within a text, and their number."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch, "")))
    flat = lists.flatten().dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in flat.dictionary.cast(pa.binary()).to_pylist()], "u8")
    row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
    index = flat.indices.to_numpy()
    if len(index):
        filled = pc.greater(pc.binary_length(flat.dictionary), 0).to_numpy(zero_copy_only=False)[index]
        index, row = index[filled], row[filled]
    word = hashes[index] if len(index) else np.zeros(0, "u8")
    counts = np.bincount(row, minlength=len(batch))
    ends = np.cumsum(counts)
    # a shingle is a polynomial over its words; a text of fewer words is one shingle of all of them
    padded = np.concatenate([word, np.zeros(WORDS, "u8")])
    shingle, left = np.zeros(len(word), "u8"), ends[row] - np.arange(len(word))
    for k in range(WORDS):
        shingle = shingle * np.uint64(MIX_A) + np.where(left > k, padded[k:k + len(word)], np.uint64(0))
    first = np.arange(len(word)) == (ends - counts)[row]
    chosen = (left >= WORDS) | (first & (counts[row] < WORDS))
    value, row = mix(shingle[chosen], 0), row[chosen]
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], np.bincount(row[new], minlength=len(batch))


def sketch(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` coordinates per set; sets must not be empty."""
    n, empty = len(counts), np.iinfo(np.uint64).max
    out = np.full(n * bins, empty, "u8")
    row = np.repeat(np.arange(n), counts)
    unfilled = np.arange(n)
    for i in range(2 * bins):
        h = mix(values, i + 1)
        place = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype("i8") if i < bins else i - bins
        np.minimum.at(out, row * bins + place, (np.uint64(i) << np.uint64(48)) | (mix(h, 0) >> np.uint64(16)))
        lacks = (out.reshape(n, bins)[unfilled] == empty).any(axis=1)
        if not lacks.any():
            break
        if not lacks.all():
            unfilled = unfilled[lacks]
            still = np.isin(row, unfilled)
            values, row = values[still], row[still]
    return out.reshape(n, bins)


def band_keys(sketches: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band."""
    n, bins = sketches.shape
    parts = sketches.reshape(n, bins // rows, rows)
    key = np.zeros((n, bins // rows), "u8")
    for k in range(rows):
        key = mix(key ^ parts[:, :, k], k)
    return key


def sketched(df: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, print_a, print_b`` (equal for equal sets), ``bands`` and ``signature``.

    The signature has one byte of every coordinate; other coordinates share it one time in 256.
    """
    schema = T.StructType([
        df.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("print_a", T.LongType()),
        T.StructField("print_b", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("signature", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in slices(batches):
            values, counts = shingle_sets(part.column(1))
            some = counts > 0
            starts = (np.cumsum(counts) - counts)[some]
            sums = [np.zeros(len(counts), "u8"), np.zeros(len(counts), "u8")]
            bands, lengths = np.zeros(0, "u8"), np.zeros(len(counts), "i8")
            signatures: list[bytes | None] = [None] * len(counts)
            if some.any():
                for k, total in enumerate(sums):
                    total[some] = np.add.reduceat(mix(values, -2 - k), starts)
                sketches = sketch(values, counts[some])
                bands = band_keys(sketches).ravel()
                lengths[some] = BANDS
                for row, own in zip(np.flatnonzero(some), mix(sketches, 1).astype("u1"), strict=True):
                    signatures[row] = own.tobytes()
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(counts.astype("i8")), *(pa.array(s.view("i8")) for s in sums),
                pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype("i4"), bands.view("i8")),
                pa.array(signatures, pa.binary()),
            ], names=schema.names)

    return df.mapInArrow(run, schema)


def with_sets(df: DataFrame) -> DataFrame:
    """``doc_id, n_shingles`` and ``items``: the ordered shingle hashes as bytes."""
    schema = T.StructType([df.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("items", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in slices(batches):
            values, counts = shingle_sets(part.column(1))
            parts = np.split(values, np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(counts.astype("i8")), pa.array([v.tobytes() for v in parts], pa.binary()),
            ], names=schema.names)

    return df.mapInArrow(run, schema)


def similar(a: pa.Scalar, b: pa.Scalar) -> bool:
    """Whether two full sets reach the similarity."""
    small, large = sorted((np.frombuffer(x.as_buffer(), "u8") for x in (a, b)), key=len)
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= SIMILAR * (len(small) + len(large) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, used: list[str]) -> DataFrame:
    """The rows of ``pairs`` (``centre, member``) whose full sets are similar.

    A centre's set is sent once for about ``PER_COPY`` of its members, so neither a common centre nor
    its group meets in one task; about ``PER_CALL`` pairs share a call.
    """
    spark = pairs.sparkSession
    large = _settled(spark, pairs.groupBy("centre").agg(F.ceil(F.count("*") / PER_COPY).alias("parts")).where(
        "parts > 1"), used, "large")
    calls = pairs.count() // PER_CALL + 1
    dealt = pairs.join(large, "centre", "left").select(
        "centre", "member", F.pmod(F.xxhash64("member"), F.coalesce("parts", F.lit(1))).alias("part"))
    dealt = dealt.select("centre", "member", F.pmod(F.xxhash64("centre", "part"), F.lit(calls)).alias("call"))
    member_sets, centre_sets = sets.toDF("member", "items"), sets.toDF("centre", "items")
    members = dealt.join(member_sets, "member").select("call", "centre", "member", "items")
    centres = dealt.select("call", "centre").distinct().join(centre_sets, "centre").toDF("centre", "call", "items")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        own = dict(zip(left.column("centre").to_pylist(), left.column("items"), strict=True))
        linked = []
        for centre, items in zip(right.column("centre").to_pylist(), right.column("items"), strict=True):
            linked.append(similar(own[centre], items))
        return right.select(["centre", "member"]).filter(pa.array(linked, pa.bool_()))

    return centres.groupBy("call").cogroup(members.groupBy("call")).applyInArrow(
        compare, pairs.select("centre", "member").schema)


def _settled(spark, df: DataFrame, used: list[str], kind: str) -> DataFrame:
    """Written once; the path is noted for release."""
    path = scratch(spark, kind)
    used.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_groups(spark, labels: DataFrame, links: DataFrame, used: list[str]) -> DataFrame:
    """``labels`` (``rep, label``) after ``links`` (``centre, member``): linked groups get the smallest label.

    Every group hooks onto the smallest group it is linked with, the trees that arise are flattened by
    pointer jumping, and this is repeated until no link joins different groups.
    """
    while True:
        a, b = labels.toDF("centre", "la"), labels.toDF("member", "lb")
        across = _settled(spark, links.join(a, "centre").join(b, "member").where("la <> lb").select(
            F.greatest("la", "lb").alias("high"), F.least("la", "lb").alias("low")).distinct(), used, "across")
        if across.isEmpty():
            return labels
        parent = _settled(spark, across.groupBy("high").agg(F.min("low").alias("low")), used, "parent")
        while True:
            up = parent.select(F.col("high").alias("low"), F.col("low").alias("top"))
            jumped = _settled(spark, parent.join(up, "low", "left").select(
                "high", F.coalesce("top", "low").alias("low"), F.col("top").isNotNull().alias("moved")), used, "parent")
            parent = jumped.select("high", "low")
            if jumped.where("moved").isEmpty():
                break
        labels = _settled(spark, labels.join(parent.select(F.col("high").alias("label"), "low"), "label", "left").select(
            "rep", F.coalesce("low", "label").alias("label")), used, "labels")


def links_left(opened: DataFrame, items: DataFrame, calls: int) -> DataFrame:
    """Links (``centre, member``) that connect different groups of a bucket.

    ``opened`` has ``bucket, rep, label, n_shingles, signature``, ``odd`` (not of the bucket's largest
    group; one of a pair always is) and ``members``, the bucket's size; ``items`` has the sets.  A bucket
    of several blocks meets block by block: odd rows go to every block, and all rows to every block of
    odd rows.  Pairs stay inside their task: the sets of their members are sent there.
    """
    rep = opened.schema["rep"].dataType
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    small = opened.where(blocks == 1).select(
        "*", F.lit(True).alias("all"), F.pmod("bucket", F.lit(calls)).alias("call"))
    large = opened.where(blocks > 1).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    as_odd = large.where("odd").withColumn("all", F.lit(False)).withColumn("call", F.xxhash64("bucket", "own", "other"))
    as_any = large.withColumn("odd", F.lit(False)).withColumn("all", F.lit(True)).withColumn(
        "call", F.xxhash64("bucket", "other", "own"))
    columns = ["call", "bucket", "rep", "label", "n_shingles", "signature", "odd", "all"]
    rows = small.select(columns).unionByName(as_odd.select(columns)).unionByName(as_any.select(columns))

    # sets go only to the calls that have likely pairs, and only those of the pairs' members
    needed = rows.groupBy("call").applyInArrow(
        _members_of_likely_pairs, T.StructType([T.StructField("call", T.LongType()), T.StructField("doc_id", rep)]))
    sent = needed.join(items, "doc_id").select(F.col("call").alias("sent_to"), "doc_id", "items")
    schema = T.StructType([T.StructField("centre", rep), T.StructField("member", rep)])
    return sent.groupBy("sent_to").cogroup(rows.groupBy("call")).applyInArrow(_links, schema)


def _likely(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each odd row with the rows of its bucket, of other groups, whose signatures are similar: likeliest first."""
    bucket, label, size = (table.column(c).to_numpy() for c in ("bucket", "label", "n_shingles"))
    odd, every = (table.column(c).to_numpy(zero_copy_only=False) for c in ("odd", "all"))
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), "u1").reshape(-1, BINS)
    order = np.argsort(bucket, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        them = group[every[group]]
        for one in group[odd[group]]:
            most, least = np.maximum(size[them], size[one]), np.minimum(size[them], size[one])
            others = them[(label[them] != label[one]) & (least * 100 >= most * SIMILAR)]
            equal = (signature[others] == signature[one]).sum(axis=1)
            likely = equal >= LIKELY * BINS
            if likely.any():
                yield one, others[likely][np.argsort(-equal[likely], kind="stable")]


def _members_of_likely_pairs(table: pa.Table) -> pa.Table:
    found: set[int] = set()
    for one, others in _likely(table):
        found.add(int(one))
        found.update(others.tolist())
    reps = table.column("rep").combine_chunks().take(pa.array(sorted(found), pa.int64())).unique()
    return pa.table([pa.repeat(table.column("call")[0], len(reps)) if len(reps) else pa.array([], pa.int64()), reps],
                    names=["call", "doc_id"])


def _links(sets: pa.Table, table: pa.Table) -> pa.Table:
    """Links between the groups of a call, no more than connect them."""
    items = dict(zip(sets.column("doc_id").to_pylist(), sets.column("items"), strict=True)) if sets.num_rows else {}
    rep, label = table.column("rep").to_pylist(), table.column("label").to_pylist()
    root: dict[object, object] = {}

    def top(x: object) -> object:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    links = []
    for one, others in _likely(table) if items else ():
        for other in others:
            a, b = top(label[one]), top(label[other])
            if a != b and similar(items[rep[one]], items[rep[other]]):
                root[a] = b
                links.append((min(rep[one], rep[other]), max(rep[one], rep[other])))
    kind = table.column("rep").type
    return pa.table([pa.array([x for x, _ in links], kind), pa.array([x for _, x in links], kind)], names=["centre", "member"])


def linked_groups(bands: DataFrame, sketches: DataFrame, documents: DataFrame) -> DataFrame:
    """``rep, label`` for the representatives in ``bands`` (``rep, bucket``) that share a bucket.

    ``sketches`` has ``rep, n_shingles, signature``.  What joins a hot bucket or centre is written first:
    Spark can then split the hot side.
    """
    spark = bands.sparkSession
    used: list[str] = []
    shared = _settled(spark, bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("centre")).where("n > 1"),
                      used, "shared")
    buckets = _settled(spark, bands.join(shared, "bucket").select("bucket", "rep", "centre"), used, "buckets")
    involved = _settled(spark, buckets.select("rep").distinct(), used, "involved")
    sets = _settled(spark, with_sets(documents.join(
        involved, documents["doc_id"] == involved["rep"], "left_semi")), used, "sets")
    items = sets.select("doc_id", "items")
    # every text with the centre that it meets most often
    met = buckets.where("centre <> rep").groupBy("rep", "centre").agg(F.count("*").alias("times"))
    best = met.groupBy("rep").agg(F.min(F.struct((-F.col("times")).alias("t"), "centre")).alias("c"))
    pairs = _settled(spark, best.select("c.centre", F.col("rep").alias("member")), used, "pairs")
    links = _settled(spark, confirmed(pairs, items, used), used, "links")
    labels = join_groups(spark, involved.select("rep", F.col("rep").alias("label")), links, used)
    # what is left: buckets that hold several groups
    counts = buckets.join(labels, "rep").groupBy("bucket", "label").agg(F.count("*").alias("n"))
    several = _settled(spark, counts.groupBy("bucket").agg(
        F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("members"), F.count("*").alias("groups")).where(
        "groups > 1").select("bucket", F.col("main.label").alias("main"), "members"), used, "several")
    opened = _settled(spark, buckets.select("bucket", "rep").join(several, "bucket").join(labels, "rep").join(sketches, "rep").select(
        "bucket", "rep", "label", "n_shingles", "signature", (F.col("label") != F.col("main")).alias("odd"), "members"),
        used, "opened")
    links = _settled(spark, links_left(opened, items, opened.count() // PER_SIEVE + 1), used, "links")
    out = written(join_groups(spark, labels, links, used))
    for path in used:
        release(spark, path)
    return out


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``df``.

    Words are runs of characters other than white space, A-Z in lower case.  A null or wordless text
    has an empty set, is linked with nothing and is its own group; one of fewer than five words has one
    shingle.  Rows that repeat an identifier are expected to repeat its text; they get the same result.
    Rows with a null identifier are linked with nothing and have a null ``component_id``.  An empty
    table gives an empty result; other columns are not read.
    """
    documents = texts(df, id_col, text_col)
    facts = written(sketched(documents))
    prints = ["print_a", "print_b", "n_shingles"]
    equal = facts.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*prints).agg(F.min("doc_id").alias("rep"))
    reps = written(equal)
    keyed = F.transform("bands", lambda key, band: F.xxhash64(band, key))
    bands = facts.join(reps.select("rep"), facts["doc_id"] == F.col("rep"), "left_semi").select(
        F.explode(keyed).alias("bucket"), F.col("doc_id").alias("rep"))
    sketches = facts.select(F.col("doc_id").alias("rep"), "n_shingles", "signature").join(reps.select("rep"), "rep", "left_semi")
    labels = linked_groups(bands, sketches, documents)
    grouped = reps.join(labels, "rep", "left").select(*prints, F.coalesce("label", "rep").alias("component_id"))
    found = facts.select("doc_id", *prints).join(grouped, prints, "left")
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", group.alias("component_id"),
                        F.col("doc_id").eqNullSafe(group).alias("kept"))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, one identifier of each group, with all their columns."""
    stay = near_dedup(df, id_col, text_col).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return df.join(stay, df[id_col].eqNullSafe(stay["__id"]), "left_semi")
