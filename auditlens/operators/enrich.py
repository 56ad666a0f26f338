"""IP enrichment (E01-E07): longest prefix by equality joins, no per-row Python.

A range table names CIDR blocks of either family: a ``network`` column
('203.0.3.0/24', '2600:1::/32'), or for IPv4 alone ``start_ip`` (bigint) and
``prefix_len``; plus payload fields. Lookup plan:

1. distinct addresses of the input that need a lookup (map-side partial
   distinct, so what follows runs on distinct addresses, not events), parsed
   to 128 bits;
2. the prefix lengths in use (at most 33 + 129 rows whatever the table's size,
   so this side is broadcast) give every address one key per length: the
   masked network;
3. an equi-join with the networks on (family, length, network): no range
   comparison, no block that collects many ranges, and Spark may broadcast or
   shuffle the networks by their size;
4. the longest prefix wins (one ``max`` per address, equal networks by their
   fields);
5. the result is joined back on the address text. Rows that are not looked up
   get distinct keys, so NULLs never meet in one task; AQE broadcasts a small
   lookup and splits a hot address.

Skip rules (E03): NULL struct for NULL, '', non-addresses and private,
loopback or link-local prefixes; a struct of NULLs for addresses that are
looked up without a hit or are not globally reachable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ip import is_public_address, mask_halves, parse_ip, skip_lookup

GEO_FIELDS = [("city", "string"), ("country", "string"), ("country_code", "string"),
              ("latitude", "double"), ("longitude", "double"), ("accuracy_radius", "int")]
ASN_FIELDS = [("as_number", "int"), ("as_org", "string"), ("as_network", "string")]


def _struct_type(fields) -> str:
    return "struct<" + ",".join(f"{n}:{t}" for n, t in fields) + ">"


def networks(ranges: DataFrame, names: list[str]) -> DataFrame:
    """family, plen, net_hi, net_lo and ``rec`` (the payload) of every CIDR block.

    Host bits in a network's text are masked off; rows that name no network
    are left out.
    """
    rec = F.struct(*[F.col(n) for n in names])
    if "network" in ranges.columns:
        text = F.col("network")
        plen = F.split_part(text, F.lit("/"), F.lit(2)).try_cast("int")
        rows = ranges.select(parse_ip(F.split_part(text, F.lit("/"), F.lit(1))).alias("a"),
                             plen.alias("plen"), rec.alias("rec"))
        rows = rows.select(F.col("a.family").alias("family"), "plen", F.col("a.hi").alias("hi"),
                           F.col("a.lo").alias("lo"), "rec")
    else:
        rows = ranges.select(F.lit(4).alias("family"), F.col("prefix_len").cast("int").alias("plen"),
                             F.lit(0).cast("bigint").alias("hi"), F.col("start_ip").alias("lo"), rec.alias("rec"))
    most = F.when(F.col("family") == 4, 32).otherwise(128)
    mask_hi, mask_lo = mask_halves(F.col("family"), F.col("plen"))
    return rows.filter(F.col("plen").between(0, most) & F.col("lo").isNotNull()).select(
        "family", "plen", F.col("hi").bitwiseAND(mask_hi).alias("net_hi"),
        F.col("lo").bitwiseAND(mask_lo).alias("net_lo"), "rec")


def prefix_lookup(addresses: DataFrame, nets: DataFrame) -> DataFrame:
    """(_ip, _rec) of the addresses (column ``_ip``, distinct texts) that a network covers."""
    lengths = nets.select("family", "plen").distinct()  # bounded by the families' bits
    mask_hi, mask_lo = mask_halves(F.col("family"), F.col("plen"))
    parsed = (addresses.select("_ip", parse_ip(F.col("_ip")).alias("_a"))
              .filter(is_public_address(F.col("_a")))
              .select("_ip", F.col("_a.family").alias("family"), F.col("_a.hi").alias("hi"), F.col("_a.lo").alias("lo")))
    keyed = parsed.join(F.broadcast(lengths), "family").select(
        "_ip", "family", "plen", F.col("hi").bitwiseAND(mask_hi).alias("net_hi"),
        F.col("lo").bitwiseAND(mask_lo).alias("net_lo"))
    return (keyed.join(nets, ["family", "plen", "net_hi", "net_lo"])
            .groupBy("_ip").agg(F.max(F.struct("plen", "rec")).alias("_best"))
            .select("_ip", F.col("_best.rec").alias("_rec")))


def range_lookup(df: DataFrame, ip_col: str, ranges: DataFrame, fields, out: str) -> DataFrame:
    """``df`` plus the struct ``out`` of the longest matching network's fields."""
    stype = _struct_type(fields)
    empty = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in fields]).cast(stype)
    ip = F.col(f"`{ip_col}`")
    wanted = df.select(ip.alias("_ip")).filter(~skip_lookup(F.col("_ip"))).distinct()
    best = prefix_lookup(wanted, networks(ranges, [n for n, _ in fields]))
    # '~' starts no address; the number spreads rows without a lookup over all tasks.
    key = F.when(skip_lookup(ip), F.concat(F.lit("~"), F.monotonically_increasing_id())).otherwise(ip)
    joined = df.withColumn("_lookup_key", key).join(best, F.col("_lookup_key") == F.col("_ip"), "left")
    return (joined.withColumn(out, F.when(skip_lookup(ip), F.lit(None).cast(stype))
                              .otherwise(F.coalesce(F.col("_rec").cast(stype), empty)))
            .drop("_lookup_key", "_ip", "_rec"))


def geo_enrich(df: DataFrame, ip_col: str, ranges: DataFrame | None, out: str = "geo") -> DataFrame:
    """E04; ``ranges=None`` (not configured) gives a typed NULL column."""
    if ranges is None:
        return df.withColumn(out, F.lit(None).cast(_struct_type(GEO_FIELDS)))
    return range_lookup(df, ip_col, ranges, GEO_FIELDS, out)


def asn_enrich(df: DataFrame, ip_col: str, ranges: DataFrame | None, out: str = "asn") -> DataFrame:
    """E05."""
    if ranges is None:
        return df.withColumn(out, F.lit(None).cast(_struct_type(ASN_FIELDS)))
    return range_lookup(df, ip_col, ranges, ASN_FIELDS, out)


def enrich(df: DataFrame, fn, *args, **kw) -> DataFrame:
    """One enrichment column per call; use as ``df.transform(enrich, geo_enrich, ...)``."""
    return fn(df, *args, **kw)
