"""Chat formatting by minimum-cost role repair.

A conversation is legal when it is an optional system turn followed by user and assistant turns in alternation, from a user
turn to an assistant turn. Dynamic programming over the automaton of legal turns finds the cheapest repair: each turn is kept
(0), relabelled (cost by the change), or merged into the turn before it; a missing user or assistant turn is put in, empty.
Of equal costs the first in the order keep, relabel, merge wins at the earliest turn. The repaired turns are rendered with
role headers.

Turns are dealt by conversation and sorted; a task reads them as a stream and holds the turns of one conversation at a time,
which is what its one rendered row holds too.

Defined cases: a null conv_id is a conversation of its own; null or unknown roles may become any role at the cost of a
relabel; null texts are empty; turns that repeat a number keep the order of role, then text; null turn numbers come first; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
RELABEL, RELABEL_SYSTEM, MERGE, INSERT = 3, 5, 2, 4
#: What may follow what: state -> states; "" is the start.
FOLLOWS = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
HEADERS = {"system": "<|system|>", "user": "<|user|>", "assistant": "<|assistant|>"}
END = "<|end|>"

Step = tuple[str, str, str]  # what was done, state before (in a finished repair: after), state put in between ("" if none)


def relabel_cost(role: str | None, to: str) -> int:
    if role == to:
        return 0
    return RELABEL_SYSTEM if to == "system" or role == "system" else RELABEL


def steps_from(state: str, role: str | None) -> Iterator[tuple[int, str, Step]]:
    """(cost, state after, step) of all ways to take a turn."""
    for to in FOLLOWS[state]:
        yield relabel_cost(role, to), to, ("keep" if role == to else "relabel", state, "")
        for after in FOLLOWS[to]:  # `to` is put in as an empty turn (never a system turn)
            if to != "system":
                yield INSERT + relabel_cost(role, after), after, ("keep" if role == after else "relabel", state, to)
    if state:
        yield MERGE + (0 if role == state else 1), state, ("merge", state, "")


def repair(roles: list[str | None]) -> tuple[int, list[Step], str]:
    """Cost, a step for each turn, and the empty turn put in at the end ("" if none)."""
    costs: dict[str, int] = {"": 0}
    trail: list[dict[str, Step]] = []
    for role in roles:
        best: dict[str, tuple[int, Step]] = {}
        for state in ("", *ROLES):
            if state in costs:
                for cost, after, step in steps_from(state, role):
                    if after not in best or costs[state] + cost < best[after][0]:
                        best[after] = costs[state] + cost, step
        costs, back = {s: c for s, (c, _) in best.items()}, {s: step for s, (_, step) in best.items()}
        trail.append(back)
    ends = {s: (c if s == "assistant" else c + INSERT if s == "user" else c + 2 * INSERT) for s, c in costs.items() if s}
    if not ends:
        return 0, [], ""
    state = min(("assistant", "user", "system"), key=lambda s: ends.get(s, 1 << 60))
    cost, close = ends[state], {"assistant": "", "user": "assistant", "system": "user+assistant"}[state]
    steps: list[Step] = []
    for back in reversed(trail):
        what, before, between = back[state]
        steps.append((what, state, between))
        state = before
    return cost, steps[::-1], close


def apply(texts: list[str], steps: list[Step], close: str) -> list[tuple[str, str]]:
    out: list[list[str]] = []
    for text, (what, role, between) in zip(texts, steps, strict=True):
        if what == "merge":
            out[-1][1] = f"{out[-1][1]}\n{text}" if out[-1][1] else text
            continue
        if between:
            out.append([between, ""])
        out.append([role, text])
    out += [[r, ""] for r in close.split("+") if r]
    return [(r, t) for r, t in out]


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{HEADERS[r]}\n{t}{END}\n" for r, t in turns)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, n_turns, n_out, n_merged, n_relabelled, n_inserted, cost, rendered."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.lower(F.trim(role_col)).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", F.col("conv_id").isNull().alias("no_id"), "role", "text")

    def finish(conv: object, roles: list[str | None], texts: list[str]) -> tuple:
        cost, steps, close = repair(roles)
        out = apply(texts, steps, close)
        done = [s[0] for s in steps]
        inserted = sum(bool(s[2]) for s in steps) + sum(bool(r) for r in close.split("+"))
        return conv, len(roles), len(out), done.count("merge"), done.count("relabel"), inserted, cost, render(out)

    names = ["conv_id", "n_turns", "n_out", "n_merged", "n_relabelled", "n_inserted", "cost", "rendered"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, roles, texts = None, [], []
        for batch in batches:
            done = []
            for conv, no_id, role, text in batch.itertuples(index=False, name=None):
                key = (None,) if no_id else (conv,)
                if roles and key != at:
                    done.append(finish(at[0], roles, texts))
                    roles, texts = [], []
                at = key
                roles.append(role if role in ROLES else None)
                texts.append(text)
            if done:
                yield _frame(done)
        if roles:
            yield _frame([finish(at[0], roles, texts)])

    def _frame(done: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(done, columns=names)
        return out.astype({"conv_id": "Int64"}) if kind in ("bigint", "int") else out

    return dealt.mapInPandas(run, f"conv_id {kind}, n_turns long, n_out long, n_merged long, n_relabelled long, n_inserted long, cost long, rendered string")
