"""Perceptual hashes: words, distances, blocks and the blocked similarity join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import cut_lineage

BITS, MOST = 256, 6


def words(hex_hash: Column, n: int = 8) -> Column:
    """A hash of hexadecimal digits as n 32-bit words."""
    return F.array(*[F.conv(F.substring(hex_hash, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(n)])


def distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def percent(d: Column, bits: int = BITS) -> Column:
    return F.round(F.lit(100.0) * (1 - d / bits), 2)


def bucket(hex_hash: Column) -> Column:
    """The first byte."""
    return F.conv(F.substring(hex_hash, 1, 2), 16, 10).cast("int")


def neighbours(b: Column) -> Column:
    """A bucket and the eight that differ from it in one bit."""
    return F.concat(F.array(b), F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: b.bitwiseXOR(F.expr("1").cast("int") * F.pow(F.lit(2), i).cast("int"))))


def pieces(words_of: Column, n_words: int, most: int, bits: int = 32) -> Column:
    """array<struct<place, piece>>: the hash in more than `most` pieces. Hashes that differ in at most `most` bits have one
    of them in common, whichever bits these are."""
    parts = 1 if n_words > most else -(-(most + 1) // n_words)
    width = bits // parts
    cut = lambda w, i, k: F.struct((i * parts + k).alias("place"), F.shiftright(w, k * width).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")).alias("piece"))
    return F.flatten(F.transform(words_of, lambda w, i: F.array(*[cut(w, i, k) for k in range(parts)])))


#: Hashes with an equal piece from which on the piece alone is no key any more.
CROWD = 1_000


def near_hashes(hashes: DataFrame, most: int = MOST, n_words: int = 8, crowd: int = CROWD) -> DataFrame:
    """(node1, node2, distance): pairs of different hashes in the same or neighbouring buckets at up to `most` bits, node1 <
    node2, each once. hashes: node, w (words), b (bucket), every hash once.

    The join is on pieces of the hash (see pieces), of which near hashes have one in common. With p pieces near hashes have
    even p - most in common; so where p is at least most + 2, a piece that more than `crowd` hashes share (plain parts of
    images) is a key only together with a second such piece: two hashes that share no other piece share two of these."""
    made = hashes.select("node", "w", "b", F.explode(pieces(F.col("w"), n_words, most)).alias("p")).select("node", "w", "b", "p.place", "p.piece")
    parts = n_words if n_words > most else n_words * -(-(most + 1) // n_words)
    single = made.withColumn("place2", F.lit(-1)).withColumn("piece2", F.lit(-1).cast("bigint"))
    if parts >= most + 2:
        crowds = made.groupBy("place", "piece").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("place", "piece", F.lit(True).alias("crowded"))
        flagged = cut_lineage(made.join(crowds, ["place", "piece"], "left"), "pieces")
        hot = flagged.filter("crowded").groupBy("node").agg(F.first("w").alias("w"), F.first("b").alias("b"), F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("p"))
        two = F.flatten(F.transform("p", lambda x: F.transform(F.filter("p", lambda y: y["place"] > x["place"]), lambda y: F.struct(x["place"].alias("place"), x["piece"].alias("piece"), y["place"].alias("place2"), y["piece"].alias("piece2")))))
        double = hot.select("node", "w", "b", F.explode(two).alias("t")).select("node", "w", "b", "t.*")
        single = flagged.filter("crowded is null").select("node", "w", "b", "place", "piece", F.lit(-1).alias("place2"), F.lit(-1).cast("bigint").alias("piece2")).unionByName(double)
    on = ["place", "piece", "place2", "piece2"]
    side = lambda n: single.select(*on, F.col("node").alias(f"node{n}"), F.col("w").alias(f"w{n}"), F.col("b").alias(f"b{n}"))
    near = side(1).join(side(2), on).filter((F.col("node1") < F.col("node2")) & F.array_contains(neighbours(F.col("b1")), F.col("b2")))
    near = near.withColumn("distance", distance(F.col("w1"), F.col("w2"))).filter(F.col("distance") <= most)
    return near.select("node1", "node2", "distance").distinct()


def hash_nodes(new: DataFrame, old: DataFrame, key: str, word: str, block: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): equal hashes as one node, named by its least key, and (node, key, is_new) of all rows. nodes: node,
    w, b, any_new, any_old. Repeated rows count once."""
    made = lambda df, is_new: df.select(F.col(key).alias("key"), F.col(word).alias("w"), F.col(block).alias("b"), F.lit(is_new).alias("is_new"))
    rows = cut_lineage(made(new, True).unionByName(made(old, False)).filter("w is not null").distinct(), "hashes")
    nodes = cut_lineage(rows.groupBy("w", "b").agg(F.min("key").alias("node"), F.max("is_new").alias("any_new"), F.max(~F.col("is_new")).alias("any_old")), "nodes")
    return nodes, rows.join(nodes.select("w", "b", "node"), ["w", "b"]).select("node", "key", "is_new")


def node_pairs(new: DataFrame, old: DataFrame, key: str, word: str, block: str, most: int = MOST, with_new: bool = True, n_words: int = 8, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): what blocked_pairs() finds, with equal hashes as one node: pairs (node1, node2, distance) of
    different nodes that have a pair with a new hash, and (node, key, is_new). Its size follows the different hashes."""
    nodes, members = hash_nodes(new, old, key, word, block)
    facts = lambda n: nodes.select(F.col("node").alias(f"node{n}"), F.col("any_new").alias(f"new{n}"), F.col("any_old").alias(f"old{n}"))
    pairs = near_hashes(nodes, most, n_words, crowd).join(facts(1), "node1").join(facts(2), "node2")
    wanted = (F.col("new1") | F.col("new2")) if with_new else (F.col("new1") & F.col("old2")) | (F.col("old1") & F.col("new2"))
    return pairs.filter(wanted).select("node1", "node2", "distance"), members


def blocked_pairs(new: DataFrame, old: DataFrame, key: str, word: str, block: str, most: int = MOST, with_new: bool = True, n_words: int = 8, crowd: int = CROWD) -> DataFrame:
    """(key1, key2, distance) of new hashes with old (and other new) ones in their own or a neighbouring bucket at up to
    `most` bits, each pair once with key1 < key2: node_pairs() with every node's members written out. Where many hashes are
    equal, take node_pairs(): n equal ones have n * (n - 1) / 2 pairs."""
    pairs, members = node_pairs(new, old, key, word, block, most, with_new, n_words, crowd)
    side = lambda n: members.select(F.col("node").alias(f"node{n}"), F.col("key").alias(f"k{n}"), F.col("is_new").alias(f"i{n}"))
    equal = members.select(F.col("node").alias("node1"), F.col("node").alias("node2"), F.lit(0).alias("distance")).distinct()
    found = pairs.unionByName(equal).join(side(1), "node1").join(side(2), "node2").filter("k1 <> k2")
    found = found.filter((F.col("i1") | F.col("i2")) if with_new else F.col("i1") != F.col("i2"))
    return found.select(F.least("k1", "k2").alias("key1"), F.greatest("k1", "k2").alias("key2"), "distance").distinct()


def hash_images(images: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, phash) of image files by a 16 x 16 DCT hash; needs PIL and imagehash, which are optional."""
    import io

    import pandas as pd

    def run(batches):
        import imagehash
        from PIL import Image, ImageOps

        for pdf in batches:
            out = []
            for p, raw in zip(pdf[path], pdf[content], strict=True):
                try:
                    img = ImageOps.exif_transpose(Image.open(io.BytesIO(raw))).convert("RGB")
                    img.thumbnail((512, 512))
                    out.append((p, str(imagehash.phash(img, hash_size=16))))
                except OSError:
                    continue
            yield pd.DataFrame(out, columns=["path", "phash"])

    return images.select(path, content).mapInPandas(run, "path string, phash string")
