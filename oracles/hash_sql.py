"""The draws of ``rosterloom.functions.draws`` as DuckDB expressions.

Both sides hash 64-bit integers with the published xxHash64; DuckDB has no function for
it, so the steps for one 8-byte value are spelled out in 128-bit arithmetic.
"""

from __future__ import annotations

from rosterloom.functions.draws import draw_tag

# Fixed values of the published algorithm.
P1, P2, P3, P4, P5 = (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
)
MOD = 1 << 64
SPARK_SEED = 42


def _rotate(x: int, r: int) -> int:
    return ((x << r) | (x >> (64 - r))) % MOD


def hash_of(value: int, seed: int) -> int:
    h = (seed + P5 + 8) % MOD
    h ^= _rotate(value * P2 % MOD, 31) * P1 % MOD
    h = (_rotate(h, 27) * P1 + P4) % MOD
    h = (h ^ (h >> 33)) * P2 % MOD
    h = (h ^ (h >> 29)) * P3 % MOD
    return h ^ (h >> 32)


def _big(n: int) -> str:
    return f"{n}::UHUGEINT"


def _let(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _hash_sql(seed: str, value: str) -> str:
    m = _big(MOD)
    last = "xor(hd, hd >> 32)"
    third = _let("hd", f"(xor(hc, hc >> 29) * {_big(P3)}) % {m}", last)
    second = _let("hc", f"(xor(hb, hb >> 33) * {_big(P2)}) % {m}", third)
    mixed = f"((((ha << 27) % {m}) + (ha >> 37)) * {_big(P1)} + {_big(P4)}) % {m}"
    first = _let("hb", mixed, second)
    start = f"xor({seed}, (((hv << 31) % {m}) + (hv >> 33)) * {_big(P1)} % {m})"
    return _let("hv", f"(({value})::UHUGEINT * {_big(P2)}) % {m}", _let("ha", start, first))


def _full(name: str, keys: tuple, seed: int) -> str:
    known = hash_of(draw_tag(name, seed), SPARK_SEED)
    text = None
    for key in keys:
        if text is None and isinstance(key, int):
            known = hash_of(key, known)
            continue
        start = _big((known + P5 + 8) % MOD) if text is None else f"(({text}) + {_big(P5 + 8)}) % {_big(MOD)}"
        text = _hash_sql(start, str(key))
    return text if text is not None else _big(known)


def u(name: str, *keys, seed: int = 42) -> str:
    """Draw in [0, 2^32) as a BIGINT expression; keys are column names or integers."""
    return f"(({_full(name, keys, seed)}) >> 32)::BIGINT"


def wide(name: str, *keys, seed: int = 42) -> str:
    """Draw in [0, 2^63)."""
    return f"(({_full(name, keys, seed)}) >> 1)::BIGINT"


def pick_place(name: str, *keys, seed: int = 42) -> str:
    """Draw in [0, 2^62)."""
    return f"(({_full(name, keys, seed)}) >> 2)::BIGINT"


def text_list(values) -> str:
    quoted = ["NULL" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values]
    return "[" + ", ".join(quoted) + "]"


def pick(draw: str, pool) -> str:
    return f"{text_list(pool)}[1 + ({draw}) % {len(pool)}]"


def choose(draw: str, options) -> str:
    """Weighted option: the first whose cumulated weight exceeds the draw's share of the total."""
    total, seen, cases = sum(w for _, w in options), 0, []
    for value, weight in options:
        seen += weight
        text = "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)
        cases.append(f"WHEN wu < {seen * 2**32 // total} THEN {text}")
    return _let("wu", draw, "CASE " + " ".join(cases) + " END")


def chance(draw: str, p: float) -> str:
    return f"(({draw}) < {int(p * 2**32)})"


def shuffled(name: str, size: int, *keys) -> str:
    """Ordinals 0..size-1 ordered by their draw."""
    mark = u(name, *keys, "si")
    ordered = f"list_sort(list_transform(range(0, {size}), lambda si: ({mark}) * 256 + si))"
    return f"list_transform({ordered}, lambda sm: sm % 256)"


def take(order: str, pool, k: str) -> str:
    """First k shuffled items of a pool."""
    return f"list_transform(({order})[1:({k})], lambda ti: {text_list(pool)}[1 + ti])"


def json_text(items: str) -> str:
    """JSON text with ', ' between items."""
    return (
        f"'[' || coalesce(array_to_string(list_transform({items}, "
        f"lambda ji: CASE WHEN ji IS NULL THEN 'null' ELSE to_json(ji)::VARCHAR END), ', '), '') || ']'"
    )


def permutation_step(x: str, rows: str, columns: str, name: str, *keys) -> str:
    """One pass of the keyed permutation over the cell ``x`` of a square with that many rows and columns."""
    text = "fr * fc + fa"
    for turn in (3, 2, 1):
        text = _let("fr", f"(fr + {u(f'{name}/up', *keys, turn, 'fa')}) % fn", text)
        text = _let("fa", f"(fa + {u(f'{name}/across', *keys, turn, 'fr')}) % fc", text)
    return _let("fc", columns, _let("fn", rows, _let("fr", f"({x}) // ({columns})", _let("fa", f"({x}) % ({columns})", text))))
