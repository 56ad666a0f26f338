"""IP addresses as plain column expressions (no UDF), IPv4 and IPv6.

An address is a struct (family, hi, lo): two BIGINTs hold its 128 bits, an
IPv4 address is the low 32 bits of ``lo``. Networks are compared by masking
(AND, then equality), so the BIGINTs' sign plays no part. Text that is no
address ('1.2.3.4:80', '::1%eth0', nine groups, ...) is NULL.
"""

from __future__ import annotations

import ipaddress
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Blocks that are not globally reachable (IANA special-purpose
# address registries), as (network, prefix length), and the registries'
# globally reachable exceptions inside them.
# ---------------------------------------------------------------------------
NOT_GLOBAL_V4 = [
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8),
    ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24),
    ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24),
    ("240.0.0.0", 4), ("255.255.255.255", 32),
]
GLOBAL_EXCEPTIONS_V4 = [("192.0.0.9", 32), ("192.0.0.10", 32)]
NOT_GLOBAL_V6 = [
    ("::", 128), ("::1", 128), ("::ffff:0:0", 96), ("64:ff9b:1::", 48), ("100::", 64),
    ("2001::", 23), ("2001:db8::", 32), ("2002::", 16), ("fc00::", 7), ("fe80::", 10),
]
GLOBAL_EXCEPTIONS_V6 = [("2001:1::1", 128), ("2001:1::2", 128), ("2001:3::", 32),
                        ("2001:4:112::", 48), ("2001:20::", 28), ("2001:30::", 28)]
IPV4_PORT_REGEX = r"^(\d+\.\d+\.\d+\.\d+):\d+$"
IPV4_REGEX = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"
#: Leading octets of addresses that are never looked up: loopback, private, link-local.
NEVER_LOOKED_UP_REGEX = r"^(127|10|192\.168|169\.254|172\.(1[6-9]|2\d|3[01]))\."

_GROUP = "[0-9A-Fa-f]{1,4}"
#: All eight groups, or any shorter lists around one '::'.
IPV6_FULL_REGEX = f"^{_GROUP}(:{_GROUP}){{7}}$"
IPV6_SHORT_REGEX = f"^({_GROUP}(:{_GROUP})*)?::({_GROUP}(:{_GROUP})*)?$"
IPV6_TAIL_REGEX = r":((?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d))$"

ADDRESS = "struct<family:int,hi:bigint,lo:bigint>"


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def halves(value: int) -> tuple[int, int]:
    """128 bits as two signed BIGINT values."""
    return _signed(value >> 64), _signed(value & ((1 << 64) - 1))


def _block(net: str, plen: int) -> tuple[int, int]:
    """First and last address of a network, as numbers."""
    n = ipaddress.ip_network(f"{net}/{plen}")
    return int(n.network_address), int(n.broadcast_address)


def strip_port(c: Column) -> Column:
    """'1.2.3.4:80' -> '1.2.3.4'; anything else unchanged (IPv6 untouched)."""
    return F.regexp_replace(c, IPV4_PORT_REGEX, "$1")


def _bound(c: Column, fn) -> Column:
    """``fn(c)`` with ``c`` evaluated once.

    A lambda variable keeps the generated code small: inlined into each of
    many tests, a parse makes it too large to compile.
    """
    return F.transform(F.array(c), fn)[0]


def ipv4_to_long(c: Column) -> Column:
    """Dotted IPv4 text -> bigint; NULL when not a valid dotted quad."""
    parts = [F.regexp_extract(c, IPV4_REGEX, k).cast("bigint") for k in (1, 2, 3, 4)]
    ok = c.rlike(IPV4_REGEX) & reduce(lambda a, b: a & b, [p <= 255 for p in parts])
    value = (parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3])
    return F.when(ok, value)


def _hex_groups(part: Column) -> Column:
    """'a:b' -> '000a000b'; '' -> ''."""
    return F.array_join(F.transform(F.filter(F.split(part, ":"), lambda g: g != ""),
                                    lambda g: F.lpad(g, 4, "0")), "")


def ipv6_hex(c: Column) -> Column:
    """IPv6 text -> its 32 hexadecimal digits; NULL when not an IPv6 address."""
    def with_hex_tail(t: Column) -> Column:
        tail = F.regexp_extract(t, IPV6_TAIL_REGEX, 1)
        digits = F.lpad(F.hex(ipv4_to_long(tail)), 8, "0")
        return F.when(tail != "", F.concat(F.substring(t, F.lit(1), F.length(t) - F.length(tail)),
                                           F.substring(digits, 1, 4), F.lit(":"), F.substring(digits, 5, 4))
                      ).otherwise(t)

    def expanded(t: Column) -> Column:
        left, right = _hex_groups(F.split_part(t, F.lit("::"), F.lit(1))), _hex_groups(F.split_part(t, F.lit("::"), F.lit(2)))
        short = F.concat(left, F.repeat(F.lit("0"), 32 - F.length(left) - F.length(right)), right)
        # '::' stands for one group at least.
        fits = F.length(left) + F.length(right) <= 28
        return (F.when(t.rlike(IPV6_FULL_REGEX), _hex_groups(t))
                .when(t.rlike(IPV6_SHORT_REGEX) & fits, short))

    return F.when(c.contains(":"), _bound(with_hex_tail(c), expanded))


def parse_ip(c: Column) -> Column:
    """Address text -> struct (family, hi, lo); NULL when it is no address."""
    def address(family: int, hi: Column, lo: Column) -> Column:
        return F.struct(F.lit(family).alias("family"), hi.alias("hi"), lo.alias("lo")).cast(ADDRESS)

    def half(digits: Column, start: int) -> Column:
        return F.conv(F.substring(digits, start, 16), 16, -10).cast("bigint")

    v4 = _bound(ipv4_to_long(c), lambda n: F.when(n.isNotNull(), address(4, F.lit(0), n)))
    v6 = _bound(ipv6_hex(c), lambda h: F.when(h.isNotNull(), address(6, half(h, 1), half(h, 17))))
    return F.coalesce(v4, v6)


def mask_halves(family: Column, prefix_len: Column) -> tuple[Column, Column]:
    """(hi, lo) masks of a prefix length in its family."""
    bits = F.when(family == 4, prefix_len + 96).otherwise(prefix_len)

    def ones(n: Column) -> Column:
        return (F.when(n <= 0, F.lit(0).cast("bigint")).when(n >= 64, F.lit(-1).cast("bigint"))
                .otherwise(F.call_function("shiftleft", F.lit(-1).cast("bigint"), (64 - n).cast("int"))))

    return ones(bits), ones(bits - 64)


def in_network(address: Column, net: str, plen: int) -> Column:
    """Whether a parsed address (of the network's family) lies in a fixed network."""
    n = ipaddress.ip_network(f"{net}/{plen}")
    v6 = n.version == 6
    hi, lo = halves(int(n.network_address))
    mask_hi, mask_lo = halves(int(n.netmask))
    same_lo = address["lo"].bitwiseAND(F.lit(mask_lo)) == F.lit(lo)
    return same_lo & (address["hi"].bitwiseAND(F.lit(mask_hi)) == F.lit(hi)) if v6 else same_lo


def is_public_address(a: Column) -> Column:
    """Global reachability of a parsed address (NULL stays NULL)."""
    def reachable(blocked, allowed) -> Column:
        some = lambda nets: reduce(lambda x, y: x | y, [in_network(a, n, p) for n, p in nets])
        return ~some(blocked) | some(allowed)

    return (F.when(a["family"] == 4, reachable(NOT_GLOBAL_V4, GLOBAL_EXCEPTIONS_V4))
            .when(a["family"] == 6, reachable(NOT_GLOBAL_V6, GLOBAL_EXCEPTIONS_V6)))


def is_public_ip(c: Column) -> Column:
    """True when globally reachable; NULL when empty, NULL or not an address."""
    return _bound(parse_ip(c), is_public_address)


def in_octet_range(c: Column, template: str, first: int, last: int) -> Column:
    """Text that starts with ``template`` filled with a number in [first, last]
    (written without leading zeros); NULL stays NULL."""
    before, after = template.split("{}")
    number = F.regexp_extract(c, f"^{re.escape(before)}(0|[1-9][0-9]*){re.escape(after)}", 1)
    return F.when(c.isNotNull(), F.coalesce(number.try_cast("bigint").between(first, last), F.lit(False)))


def skip_lookup(c: Column) -> Column:
    """Texts that are never looked up: NULL, anything without '.' or ':', and
    loopback, private and link-local addresses by their leading octets."""
    return c.isNull() | ~c.rlike("[.:]") | c.rlike(NEVER_LOOKED_UP_REGEX)
