"""Analysis types: detection by keyword, prompts and settings."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweft.fixed_values import GENERAL, SYSTEM_PROMPTS, TASK_BLOCKS, TYPE_KEYWORDS, TYPE_SETTINGS


@dataclass(frozen=True)
class AnalysisTypes:
    """The known analysis types.  ``keywords`` is in order of precedence."""

    keywords: dict = field(default_factory=lambda: dict(TYPE_KEYWORDS))
    system_prompts: dict = field(default_factory=lambda: dict(SYSTEM_PROMPTS))
    tasks: dict = field(default_factory=lambda: dict(TASK_BLOCKS))
    settings: dict = field(default_factory=lambda: dict(TYPE_SETTINGS))

    def register_type(
        self,
        name: str,
        keywords: list[str] = (),
        system_prompt: str | None = None,
        task: str | None = None,
        settings: tuple[float, int, int] | None = None,
        before: str | None = None,
    ) -> "AnalysisTypes":
        """A copy that also knows ``name``; it is tried last, or right before type ``before``.

        Parts left out fall back to those of the general type.
        """
        order = {}
        for known, words in self.keywords.items():
            if known == before:
                order[name] = list(keywords)
            if known != name:
                order[known] = words
        order.setdefault(name, list(keywords))
        extra = {"system_prompts": system_prompt, "tasks": task, "settings": settings}
        return replace(self, keywords=order, **{
            part: {**getattr(self, part), name: value} for part, value in extra.items() if value is not None})

    def names(self) -> list[str]:
        return [GENERAL, *self.keywords]


DEFAULT_TYPES = AnalysisTypes()


def detect_analysis_type(text: Column, types: AnalysisTypes = DEFAULT_TYPES) -> Column:
    """First type with a keyword anywhere in the lower-cased text, also inside words; else general."""
    lowered = F.lower(text)
    chain, tried = None, []
    for name, all_words in types.keywords.items():
        # A word that contains one tried before it can add nothing.
        words = []
        for word in all_words:
            if not any(earlier in word for earlier in tried):
                words.append(word)
                tried.append(word)
        if not words:
            continue
        hit = lowered.contains(words[0])
        for word in words[1:]:
            hit = hit | lowered.contains(word)
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return F.lit(GENERAL) if chain is None else chain.otherwise(F.lit(GENERAL))


def forced_type(forced: str | Column | None, detected: Column) -> Column:
    """The type the caller set, else the detected one."""
    return detected if forced is None else F.coalesce(F.lit(forced) if isinstance(forced, str) else forced, detected)


def _by_type(kind: Column, values: dict) -> Column:
    """Value of a type, that of the general type for unknown ones (a few rows at most: an inline map)."""
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.lit(values[GENERAL]))


def system_prompt(kind: Column, types: AnalysisTypes = DEFAULT_TYPES) -> Column:
    return _by_type(kind, types.system_prompts)


def task_block(kind: Column, types: AnalysisTypes = DEFAULT_TYPES) -> Column:
    return _by_type(kind, types.tasks)


def analysis_config(kind: Column, types: AnalysisTypes = DEFAULT_TYPES) -> Column:
    """``struct(temperature, max_tokens, timeout)`` of a type."""
    return F.struct(
        _by_type(kind, {name: s[0] for name, s in types.settings.items()}).alias("temperature"),
        _by_type(kind, {name: s[1] for name, s in types.settings.items()}).alias("max_tokens"),
        _by_type(kind, {name: s[2] for name, s in types.settings.items()}).alias("timeout"),
    )
