"""An index of bound rules: which checks there are, and which rules an application has.

Rules that share type, column and parameters share one check, and a check is one bit in a
few words. For each application that a rule names the index holds the bits of the checks
that its rules ask for. So one lookup tells which checks a row has to pass: only those are
evaluated, words without any are passed over, and the rules behind failed checks are looked
at for invalid rows alone.

An application that no rule names has the base rules; the others differ from it in the
rules that name them. So the index grows with the length of all scope lists, not with
applications times rules.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from rowsieve.plans.rules import Rule

# Checks in a word; the sign is left alone.
CHECKS_IN_WORD = 60
# Applications that share a bucket, about.
_BUCKET = 4

ENTRY_TYPE = "struct<covered:array<bigint>,unsure:array<bigint>,added:array<int>,maybe:array<int>,dropped:array<int>>"


def scope_state(rule: Rule, application: str | None) -> bool | None:
    """Whether a rule covers an application, in the three-valued logic of SQL lists."""
    included = True if rule.include is None else _among(application, rule.include)
    if included is False or not rule.exclude:
        return included
    excluded = _among(application, rule.exclude)
    if excluded is True:
        return False
    return None if excluded is None else included


def _among(application: str | None, names: Sequence[str | None]) -> bool | None:
    if application is None:
        return None
    if application in names:
        return True
    return None if None in names else False


# Stands for every application that no rule names.
_OTHER = "\0"


@dataclass
class RuleIndex:
    """``checks[i]`` is the number of rule i's check; equal numbers share a check."""

    rules: Sequence[Rule]
    checks: Sequence[int]
    base: dict = field(init=False)
    null: dict = field(init=False)
    named: dict[str, dict] = field(init=False)

    def __post_init__(self):
        self.words = -(-(max(self.checks, default=-1) + 1) // CHECKS_IN_WORD)
        self._base_states = [scope_state(r, _OTHER) for r in self.rules]
        self._counts: dict[bool | None, dict[int, int]] = {True: {}, None: {}}
        for check, state in zip(self.checks, self._base_states, strict=True):
            if state is not False:
                held = self._counts[state]
                held[check] = held.get(check, 0) + 1
        self.base = self._entry([])
        self.null = self._entry(range(len(self.rules)), None)
        naming: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            for name in {*(rule.include or ()), *rule.exclude} - {None}:
                naming.setdefault(name, []).append(i)
        self.named = {name: self._entry(which, name) for name, which in naming.items()}

    @property
    def is_scoped(self) -> bool:
        return any(r.include is not None or r.exclude for r in self.rules)

    @cached_property
    def asked_by_all(self) -> set[int]:
        """Checks that some rule asks of every row."""
        return {c for c, r in zip(self.checks, self.rules, strict=True) if r.include is None and not r.exclude}

    @property
    def base_rules(self) -> list[int]:
        return [i for i, s in enumerate(self._base_states) if s is True]

    def _entry(self, which: Sequence[int], application: str | None = _OTHER) -> dict:
        """Masks of an application, and how its rules differ from the base."""
        entry = {"added": [], "maybe": [], "dropped": []}
        changed: dict[bool | None, dict[int, int]] = {True: {}, None: {}}
        maybe = {i for i, s in enumerate(self._base_states) if s is None}
        for i in which:
            before, now = self._base_states[i], scope_state(self.rules[i], application)
            if before == now:
                continue
            for state, step in ((before, -1), (now, 1)):
                if state is not False:
                    of = changed[state]
                    of[self.checks[i]] = of.get(self.checks[i], 0) + step
            if before is True:
                entry["dropped"].append(i)
            if now is True:
                entry["added"].append(i)
            maybe = maybe | {i} if now is None else maybe - {i}
        entry["maybe"] = sorted(maybe)
        for name, state in (("covered", True), ("unsure", None)):
            entry[name] = self._mask(self._counts[state], changed[state])
        return entry

    def _mask(self, counts: dict[int, int], changed: dict[int, int]) -> list[int]:
        words = [0] * self.words
        for check in counts.keys() | changed.keys():
            if counts.get(check, 0) + changed.get(check, 0) > 0:
                word, at = divmod(check, CHECKS_IN_WORD)
                words[word] |= 1 << at
        return words

    def buckets(self) -> tuple[int, str]:
        """The named applications in buckets by checksum: their number, and a JSON array of
        maps. A lookup walks through one small map."""
        count = max(1, -(-len(self.named) // _BUCKET))
        out: list[dict[str, dict]] = [{} for _ in range(count)]
        for name, entry in self.named.items():
            out[zlib.crc32(name.encode()) % count][name] = entry
        return count, json.dumps(out)
