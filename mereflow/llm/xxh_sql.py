"""XXH64 as DuckDB SQL, for the oracle of the fingerprints: 128-bit numbers, taken modulo 2^64."""

from __future__ import annotations

M = 1 << 64
#: The five primes of XXH64.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261


def _n(x: int) -> str:
    return f"{x % M}::uhugeint"


def _mul(a: str, p: int) -> str:
    return f"(({a}) * {_n(p)} % {M}::uhugeint)"


def _add(a: str, p: int) -> str:
    return f"((({a}) + {_n(p)}) % {M}::uhugeint)"


def _rotl(a: str, r: int) -> str:
    return f"list_transform([{a}], lambda v: (v * {1 << r}::uhugeint) % {M}::uhugeint + v // {1 << (64 - r)}::uhugeint)[1]"


def _xor(a: str, b: str) -> str:
    return f"cast(xor(cast({a} as ubigint), cast({b} as ubigint)) as uhugeint)"


def _shifted(a: str, r: int) -> str:
    return f"list_transform([{a}], lambda v: {_xor('v', f'v // {1 << r}::uhugeint')})[1]"


def _read(hx: str, at: str, size: int) -> str:
    """The little-endian number of ``size`` bytes from byte ``at`` on of the hex text."""
    parts = " || ".join(f"substr({hx}, cast(2 * ({at}) + {2 * k + 1} as bigint), 2)" for k in reversed(range(size)))
    return f"cast(cast('0x' || {parts} as ubigint) as uhugeint)"


def _round(acc: str, lane: str) -> str:
    return _mul(_rotl(f"({acc} + {_mul(lane, P2)}) % {M}::uhugeint", 31), P1)


def xxh64(source: str, name: str, seed: int = 42) -> str:
    """CTEs that end in ``name``: (g, h) with h as ubigint, for the distinct texts g of ``source``."""
    merge = lambda acc, v: _add(_mul(_xor(acc, _round(_n(0), v)), P1), P4)
    starts = (seed + P1 + P2, seed + P2, seed, seed - P1)
    lanes = ", ".join(f"list_reduce(list_transform(range(0, n // 32), lambda i: {_read('hx', f'32 * i + {8 * j}', 8)}), lambda a, x: {_round('a', 'x')}, {_n(starts[j])}) as v{j}" for j in range(4))
    mixed = f"({_rotl('v0', 1)} + {_rotl('v1', 7)} + {_rotl('v2', 12)} + {_rotl('v3', 18)}) % {M}::uhugeint"
    mixed = merge(mixed, "v0")
    return f"""
{name}a as materialized (select g, hex(encode(g)) as hx, strlen(g) as n from {source}),
{name}b as (select *, {lanes} from {name}a),
{name}c0 as (select *, {mixed} as m0 from {name}b),
{name}c1 as (select *, {merge('m0', 'v1')} as m1 from {name}c0),
{name}c2 as (select *, {merge('m1', 'v2')} as m2 from {name}c1),
{name}c3 as (select *, {merge('m2', 'v3')} as m3 from {name}c2),
{name}d as (select g, hx, n, n // 32 * 32 as o, ((case when n >= 32 then m3 else {_n(seed + P5)} end) + cast(n as uhugeint)) % {M}::uhugeint as acc from {name}c3),
{name}e as (select g, hx, n, o + (n - o) // 8 * 8 as o, list_reduce(list_transform(range(0, (n - o) // 8), lambda i: {_read('hx', 'o + 8 * i', 8)}), lambda a, x: {_add(_mul(_rotl(_xor('a', _round(_n(0), 'x')), 27), P1), P4)}, acc) as acc from {name}d),
{name}f as (select g, hx, n, case when n - o >= 4 then o + 4 else o end as o, case when n - o >= 4 then {_add(_mul(_rotl(_xor('acc', _mul(_read('hx', 'o', 4), P1)), 23), P2), P3)} else acc end as acc from {name}e),
{name}g as (select g, list_reduce(list_transform(range(0, n - o), lambda i: {_read('hx', 'o + i', 1)}), lambda a, x: {_mul(_rotl(_xor('a', _mul('x', P5)), 11), P1)}, acc) as acc from {name}f),
{name} as materialized (select g, cast({_shifted(_mul(_shifted(_mul(_shifted('acc', 33), P2), 29), P3), 32)} as ubigint) as h from {name}g)"""
