"""WARC (7): archives of pages, and a reader that verifies the chain of record boundaries.

Writing: one record a page; Spark's text writer ends every record with the blank lines the
format asks for (its line separator) and works on any file system Spark writes to.

Reading: the text reader cuts files at every magic (its line separator), also at one inside a
payload. Each cut gives a candidate offset and, from its header, the offset of the record that
follows. From a file's start the chain is followed inside blocks of the file (one task a
block), and from block to block by pointer jumping on Spark joins; candidates that the chain
does not reach are payload, and go back into the payload they were cut from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import by_group, cut

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
BLOCK = 1 << 20
# fixed value: the format's name for revisits that are found by an equal payload digest
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
# fixed value: the alphabet of base 32
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(digest: Column) -> Column:
    """A hex SHA-1 in base 32 (null: null): each 5 hex digits are 4 letters."""
    def letters(part: Column) -> Column:
        bits = F.conv(F.substr(digest, part * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])
    # joining an array of nulls would give an empty text
    return F.when(digest.isNotNull(), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), ""))


def _line(value: Column) -> Column:
    """A header value: no line breaks, and a space more (that ``_unlined`` takes away) where it would make
    the magic with the line break after it."""
    plain = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "[\\r\\n]+", " ")
    return F.regexp_replace(plain, "(WARC/1\\.0 *)\\z", "$1 ")


def _unlined(value: Column) -> Column:
    return F.regexp_replace(value, "(WARC/1\\.0 *) \\z", "$1")


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is the smallest page_id of the pages of
    equal payload (of at least ``min_bytes``) where it is another page (a null page_id is one), else null."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest", F.octet_length("payload").alias("_size"))
             .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    first = cut(first, "warc-equal")  # a table of known size: where few payloads are equal, no payload is shuffled
    joined = rows.join(first, (rows.digest == first.digest) & (F.octet_length("payload") == F.col("_size")), "left").drop(first.digest)
    return joined.select("page_id", "url", "payload", base32(F.col("digest")).alias("digest"),
                         F.when(~F.col("_first").eqNullSafe(F.col("page_id")), F.col("_first")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, compression: str = "gzip") -> None:
    """One record per row of ``pages`` (page_id, url, html). Null html is an empty payload; a null
    page_id or url is an empty header value; repeated rows are records of their own (all
    rows of the smallest page_id are responses). Other columns are ignored. A record's id is its page_id
    and a random UUID, so that repeated and null page_ids have ids of their own. A revisit has no block;
    its header names the profile (equal payload digests), the payload's digest and length and, in a header of our
    own, the page it refers to. WARC-Date is the time of writing (UTC). With ``compression`` a file is
    one member: offsets are those of the uncompressed bytes, and only ``none`` lets a reader seek to them."""
    rows = with_originals(pages, min_bytes)
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("payload").cast("string")
    written = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = F.concat_ws(
        "\r\n",
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), _line(F.col("page_id")), F.lit(":"), F.uuid(), F.lit(">")),
        F.concat(F.lit("WARC-Date: "), written),
        F.concat(F.lit("WARC-Target-URI: "), _line(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")).otherwise(F.lit("Content-Type: text/html; charset=utf-8")),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page: "), F.col("refers_to").cast("string"))),
        F.when(revisit, F.concat(F.lit("X-Payload-Length: "), size)),
        F.concat(F.lit("Content-Length: "), F.when(revisit, "0").otherwise(size)))
    record = F.concat(F.lit(MAGIC), head, F.lit(END), F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")))
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def _header(name: str, pattern: str) -> Column:
    return F.regexp_extract(F.col("_head"), f"(?i)(?:^|\\r\\n){name}: *{pattern}", 1)


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (value, file, split, bytes) with the bytes before each in its split, summed where it is read."""
    before: dict[tuple, int] = {}
    for b in batches:
        into = []
        for at in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            into.append(before.get(at[:2], 0))
            before[at[:2]] = into[-1] + at[2]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(into, pa.int64())], ["value", "file", "split", "bytes", "into"])


def lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per magic: (file, off, size, bytes, value, _size, _length, _entire): the text up to the next
    magic, offset and file size in uncompressed bytes, the header's size, the length it gives,
    and whether the text is a whole record."""
    raw = (spark.read.option("lineSep", MAGIC).text(path)
           .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                   (F.octet_length("value").cast("long") + len(MAGIC)).alias("bytes")))
    raw = cut(raw.mapInArrow(_sums, "value string, file string, split long, bytes long, into long"), "warc-lines")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = (raw.groupBy("file", "split").agg(F.sum("bytes").alias("sum"))
              .withColumn("start", F.coalesce(F.sum("sum").over(before), F.lit(0)))
              .withColumn("size", F.sum("sum").over(Window.partitionBy("file")) - len(MAGIC)))
    starts = cut(starts.drop("sum"), "warc-starts")  # one row a split, of known size: no line is shuffled
    return (raw.join(starts, ["file", "split"])
            .withColumn("off", F.col("start") + F.col("into") - len(MAGIC)).where("off >= 0")
            .withColumn("_head", F.substring_index("value", END, 1))
            .withColumn("_size", F.octet_length("_head").cast("long") + len(END))
            .withColumn("_length", F.expr("try_cast(regexp_extract(_head, '(?i)(?:^|\\r\\n)Content-Length: *([0-9]+) *(?:\\r\\n|$)', 1) as bigint)"))
            .withColumn("_length", F.when(F.octet_length("_head") < F.octet_length("value"), F.col("_length")))
            .withColumn("_entire", F.coalesce(F.col("_size") + F.col("_length") + len(END) == F.col("bytes") - len(MAGIC), F.lit(False)))
            .select("file", "off", "size", "bytes", "value", "_head", "_size", "_length", "_entire"))


def candidates(read: DataFrame) -> DataFrame:
    """(file, off, next, _size, _length, _entire) of ``lines``; next is null where the header gives no
    length or the file ends before it."""
    after = F.col("off") + len(MAGIC) + F.col("_size") + F.col("_length") + len(END)
    return cut(read.select("file", "off", F.when(after <= F.col("size"), after).alias("next"), "_size", "_length", "_entire"), "warc-candidates")


def reachable(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """(file, off) of the candidates on the chain from each file's start."""
    links = found.where("next is not null").select("file", "off", "next").withColumn("blk", F.floor(F.col("off") / block))

    def exits(key, part: pd.DataFrame) -> pd.DataFrame:
        """The first offset outside the block on the chain from each candidate."""
        limit = (int(key[1]) + 1) * block
        part = part.drop_duplicates("off").sort_values("off")
        to = dict(zip(part.off, part.next, strict=True))
        out: dict[int, int] = {}
        for off in reversed(part.off.tolist()):
            nxt = to[off]
            out[off] = nxt if nxt >= limit else out.get(nxt, -1)
        return pd.DataFrame({"file": key[0], "off": list(out), "jump": list(out.values())})

    hops = cut(by_group(links, ["file", "blk"], exits, "file string, off long, jump long").where("jump >= 0"), "warc-exits")
    # of the candidates, only those that a chain enters a block at can be on the way
    entry = hops.select("file", F.col("jump").alias("off")).distinct()
    step = cut(hops.join(entry, ["file", "off"], "left_semi").unionByName(hops.where("off = 0")), "warc-jumps")
    reached = cut(found.where("off = 0").select("file", "off").distinct(), "warc-reached")
    known = reached.count()
    while True:
        more = reached.join(step, ["file", "off"]).select("file", F.col("jump").alias("off"))
        reached = cut(reached.union(more).distinct(), "warc-reached")
        now = reached.count()
        if now == known:
            break
        known = now
        ahead = step.select("file", F.col("off").alias("jump"), F.col("jump").alias("further"))
        step = cut(step.join(ahead, ["file", "jump"]).select("file", "off", F.col("further").alias("jump")).distinct(), "warc-jumps")

    def follow(key, part: pd.DataFrame) -> pd.DataFrame:
        to = dict(zip(part.off[~part.entered], part.next[~part.entered], strict=True))
        on: list[int] = []
        for at in sorted(part.off[part.entered]):
            while at in to:
                on.append(at)
                at = to[at]
        on = sorted(set(on))
        return pd.DataFrame({"file": [key[0]] * len(on), "off": np.asarray(on, np.int64)})

    rows = links.withColumn("entered", F.lit(False)).unionByName(
        reached.select("file", "off", F.lit(0).cast("long").alias("next"), F.floor(F.col("off") / block).alias("blk"), F.lit(True).alias("entered")))
    return by_group(rows, ["file", "blk"], follow, "file string, off long")


def read_warc(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """Records on the boundary chain: (file, off, page_id, url, record_type, refers_to,
    payload_bytes, payload_digest, payload). A revisit's payload is null; its bytes and digest are those of
    its header. A chain ends at a record whose header has no length or that the file's end cuts
    off; what follows is not read. An empty file or folder of empty files gives no rows."""
    read = lines(spark, path)
    found = candidates(read)
    chain = cut(reachable(found, block), "warc-chain")
    # records that hold a magic: their pieces are the candidates up to the next record
    broken = found.where("not _entire").join(chain, ["file", "off"]).select("file", "off", "next", "_size", "_length")
    blocks = broken.withColumn("blk", F.explode(F.sequence(F.floor(F.col("off") / block), F.floor((F.col("next") - 1) / block))))
    pieces = found.select("file", F.col("off").alias("at")).withColumn("blk", F.floor(F.col("at") / block))
    owned = (pieces.join(blocks, ["file", "blk"]).where("at >= off and at < next")
             .select("file", "at", "off", "_size", "_length"))
    owned = cut(owned, "warc-owned")  # of known size: where few records hold a magic, no line is shuffled
    texts = owned.join(read.select("file", F.col("off").alias("at"), "value"), ["file", "at"])
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda p: p.value), MAGIC)
    whole = texts.groupBy("file", "off", "_size", "_length").agg(joined.alias("_all"))

    def body(text: str) -> Column:
        return F.col(text).cast("binary").substr(F.col("_size").cast("int") + 1, F.col("_length").cast("int"))

    mended = cut(whole.select("file", "off", body("_all").alias("_mended")), "warc-mended")
    # the lines that are no records are few where few records hold a magic: payloads stay where they are
    others = cut(found.join(chain, ["file", "off"], "left_anti").select("file", "off"), "warc-others")
    records = read.join(others, ["file", "off"], "left_anti").join(mended, ["file", "off"], "left")
    kind = _header("WARC-Type", "(\\w+)")
    revisit = F.col("record_type") == "revisit"
    number = "try_cast(regexp_extract(_head, '(?i)(?:^|\\r\\n){}', 1) as bigint)"
    out = (records.withColumn("record_type", F.lower(kind))
           .withColumn("page_id", F.expr(number.format("WARC-Record-ID: *<urn:page:(-?[0-9]+)[:>]")))
           .withColumn("refers_to", F.expr(number.format("X-Refers-To-Page: *(-?[0-9]+)")))
           .withColumn("url", F.nullif(_unlined(_header("WARC-Target-URI", "([^\\r\\n]*)")), F.lit("")))
           .withColumn("payload", F.when(revisit, F.lit(None)).when(F.col("_entire"), body("value")).otherwise(F.col("_mended")))
           .withColumn("payload_bytes", F.when(revisit, F.expr(number.format("X-Payload-Length: *([0-9]+)"))).otherwise(F.octet_length("payload").cast("long")))
           .withColumn("_sha1", F.sha1("payload"))
           .withColumn("payload_digest", F.when(revisit, _header("WARC-Payload-Digest", "sha1:([A-Z2-7]+)")).otherwise(base32(F.col("_sha1")))))
    return out.select("file", "off", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
