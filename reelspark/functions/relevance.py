"""Keyword evidence: scores of texts against a scenario, and what they say of place and scenario."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelspark.functions import fixed_values as V
from reelspark.functions.taxonomy import ScenarioSpec

MOST_HITS = 3
WEIGHTS = {"env": 2.0, "subject": 1.5, "actions": 1.5, "negative": -3.0}


@dataclass(frozen=True)
class Lexicon:
    environments: dict[str, tuple[str, ...]] = field(default_factory=lambda: V.ENV_KEYWORDS)
    subjects: tuple[str, ...] = V.SUBJECT_KEYWORDS
    actions: dict[str, tuple[str, ...]] = field(default_factory=lambda: V.ACTION_KEYWORDS)
    negatives: tuple[str, ...] = V.NEGATIVE_KEYWORDS


def hits(text: Column, words) -> Column:
    """How many of the words the text contains, as substrings."""
    return reduce(add, [text.contains(w).cast("int") for w in words], F.lit(0))


def _any(text: Column, words) -> Column:
    return reduce(or_, [text.contains(w) for w in words], F.lit(False))


def relevance(text: Column, spec: ScenarioSpec, lexicon: Lexicon = Lexicon()) -> Column:
    """struct(score, actions, env, subject, negative) of a lower-cased text.

    Hits of environment and subject count MOST_HITS at most; actions and negatives all count.
    """
    env = reduce(add, [hits(text, lexicon.environments.get(e, ())) for e in spec.environments], F.lit(0))
    subject, negative = hits(text, lexicon.subjects), hits(text, lexicon.negatives)
    actions = F.array_compact(F.array(*[F.when(_any(text, lexicon.actions.get(a, ())), F.lit(a)) for a in spec.actions]))
    score = F.least(env, F.lit(MOST_HITS)) * WEIGHTS["env"] + F.least(subject, F.lit(MOST_HITS)) * WEIGHTS["subject"] + F.size(actions) * WEIGHTS["actions"] + negative * WEIGHTS["negative"]
    return F.struct(score.alias("score"), actions.alias("actions"), env.alias("env"), subject.alias("subject"), negative.alias("negative"))


def env_of(text: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """The first environment of the vocabulary whose words the text has, or unknown."""
    return F.coalesce(*[F.when(_any(text, lexicon.environments.get(e, ())), F.lit(e)) for e in V.ENV_TYPES], F.lit("unknown"))


def scenario_of(text: Column, spec: ScenarioSpec, lexicon: Lexicon = Lexicon()) -> Column:
    words = [w for e in spec.environments for w in lexicon.environments.get(e, ())]
    return F.when(_any(text, words), F.lit(spec.scenario_type)).otherwise(F.lit("unknown"))


def joined_text(*parts: Column) -> Column:
    """Non-empty parts, joined by spaces and lower-cased."""
    return F.lower(F.array_join(F.array_compact(F.array(*[F.when(p != "", p) for p in parts])), " "))
