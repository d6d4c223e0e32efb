"""IP addresses: membership in CIDR ranges and order keys for range joins."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

_V4 = r"^\s*(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\s*$"


def ipv4_number(ip: Column) -> Column:
    """A dotted address as a number; null if it isn't one."""
    parts = F.split(F.trim(ip), r"\.")
    value = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x.try_cast("bigint"))
    return F.when(ip.rlike(_V4), value)


def ipv6_digits(ip: Column) -> Column:
    """A colon address as 32 hexadecimal digits, which order as addresses do; null if it isn't one."""
    text = F.lower(F.trim(ip))
    dotted = F.regexp_extract(text, r":(\d+\.\d+\.\d+\.\d+)$", 1)  # the last 32 bits may be written as in IPv4
    last = ipv4_number(dotted)
    hexes = lambda n: F.lower(F.hex(n))
    text = F.when(dotted != "", F.concat(F.regexp_replace(text, r"\d+\.\d+\.\d+\.\d+$", ""), hexes(F.shiftright(last, 16)), F.lit(":"), hexes(last.bitwiseAND(F.lit(65535))))).otherwise(text)
    sides = F.split(text, "::", -1)
    groups = lambda side: F.filter(F.split(F.coalesce(side, F.lit("")), ":"), lambda x: x != "")
    left, right = groups(F.get(sides, F.lit(0))), groups(F.get(sides, F.lit(1)))
    gap = F.lit(8) - F.size(left) - F.size(right)
    form = text.rlike("^(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*)?(?:::)?(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*)?$") & text.contains(":")
    whole = F.when(F.size(sides) == 2, gap >= 1).otherwise(gap == 0)
    padded = F.transform(F.concat(left, F.array_repeat(F.lit("0"), F.greatest(F.lit(0), gap)), right), lambda x: F.lpad(x, 4, "0"))
    return F.when(form & whole, F.array_join(padded, ""))


def number_key(number: Column) -> Column:
    """An IPv4 address as a number, as text that orders as addresses do; IPv6 comes after IPv4."""
    return F.concat(F.lit("4"), F.lpad(F.lower(F.hex(number.cast("bigint"))), 8, "0"))


def order_key(ip: Column) -> Column:
    """An address of either version as text that orders as addresses do; null if it isn't one."""
    return F.coalesce(number_key(ipv4_number(ip)), F.concat(F.lit("6"), ipv6_digits(ip)))


def in_ranges(ip: Column, cidrs: list[str]) -> Column:
    """True if the address lies in one of the ranges; what is no address lies in none."""
    nets = [ipaddress.ip_network(c.strip(), strict=False) for c in cidrs]
    number, digits, hit = ipv4_number(ip), ipv6_digits(ip), F.lit(False)
    for n in nets:
        low, high = int(n.network_address), int(n.broadcast_address)
        inside = (number >= low) & (number <= high) if n.version == 4 else (digits >= f"{low:032x}") & (digits <= f"{high:032x}")
        hit = hit | F.coalesce(inside, F.lit(False))
    return hit
