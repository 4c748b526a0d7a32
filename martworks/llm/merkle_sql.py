"""The Merkle manifest as SQL: trees of up to 16^5 leaves a source and 16^5 sources."""

from __future__ import annotations

DEPTH = 5

#: crc32 bit by bit: each byte is taken in, then eight shifts, which stand as -1.
_CRC = """xor(list_reduce(
    flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(cast({id} as varchar), '')]),
    lambda h, x: case when x >= 0 then xor(h, cast(x as bigint))
      else xor(h >> 1, 3988292384 * (h & 1)) end, cast(4294967295 as bigint)), cast(4294967295 as bigint))"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    values = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(
        f"coalesce(strlen(cast({v} as varchar)) || ':' || cast({v} as varchar), '-')" for v in values
    ) + ")"


def _tree(name: str, base: str) -> list[str]:
    """Levels {name}0 .. of the trees by ``g``; a tree that has one node keeps it."""
    levels = [f"{name}0 as ({base})"]
    for k in range(DEPTH):
        levels.append(
            f"{name}{k + 1} as (select g, p // 16 as p, (n + 15) // 16 as n, "
            f"case when n > 1 then sha256(string_agg(d, '' order by p)) else min(d) end as d "
            f"from {name}{k} group by g, p // 16, n)"
        )
    for k in range(DEPTH):
        run = "partition by g, p // 16 order by p rows between"
        levels.append(
            f"{name}s{k} as (select g, p, n, "
            f"coalesce(string_agg(d, '') over ({run} unbounded preceding and 1 preceding), '') as l, "
            f"coalesce(string_agg(d, '') over ({run} 1 following and unbounded following), '') as r from {name}{k})"
        )
    return levels


def _climb(name: str, before: str, group: str, place: str) -> list[str]:
    """Steps that take each document's proof and folded node up through all levels."""
    steps = []
    for k in range(DEPTH):
        steps.append(
            f"{name}c{k} as (select f.* replace (proof || s.l || s.r as proof, "
            f"case when s.n > 1 then sha256(s.l || x || s.r) else x end as x) "
            f"from {before} f join {name}s{k} s on f.{group} is not distinct from s.g and f.{place} // {16**k} = s.p)"
        )
        before = f"{name}c{k}"
    return steps


def manifest() -> str:
    leaves = f"""leaves as (
  select doc_id, source, {_leaf("text")} as leaf,
    case when {_CRC.format(id="doc_id")} % 5 = 0 then {_leaf(_LOWER)} end as tampered from documents)"""
    numbered = """numbered as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from leaves)"""
    own = _tree("a", "select source as g, place as p, count(*) over (partition by source) as n, leaf as d from numbered")
    ranked = f"""ranked as (
  select g as source, d as subroot, row_number() over (order by g nulls first) - 1 as rank from a{DEPTH})"""
    top = _tree("b", "select 0 as g, rank as p, count(*) over () as n, subroot as d from ranked")
    start = f"""start as (
  select i.*, subroot, rank, 0 as zero, (select d from b{DEPTH}) as root, '' as proof, coalesce(tampered, leaf) as x
  from numbered i join ranked r on i.source is not distinct from r.source)"""
    steps = [leaves, numbered, *own, ranked, *top, start, *_climb("a", "start", "source", "place")]
    steps += _climb("b", f"ac{DEPTH - 1}", "zero", "rank")
    body = ",\n".join(steps)
    return f"""
with {body}
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, x as folded_root, x = root as verified
from bc{DEPTH - 1}
"""
