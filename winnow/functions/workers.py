"""What a Python worker keeps for the life of its process."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Sequence
from typing import TypeVar

Model = TypeVar("Model")
KEPT = "_winnow_models"


def kept(name: str | None, load: Callable[[], Model]) -> Model:
    """What ``load`` returns, loaded once per process under a name; each time where there is none.

    Spark reuses its Python workers, so a model costs one load a worker and not one a task.  The place is a module
    that no package provides, as workers need not have this one.
    """
    if name is None:
        return load()
    held = sys.modules.setdefault(KEPT, types.ModuleType(KEPT)).__dict__
    if name not in held:
        held[name] = load()
    return held[name]


def as_many(asked: Sequence, answers: Sequence, what: str) -> Sequence:
    """The answers, if there is one for each question; they could not be told apart otherwise."""
    if len(answers) != len(asked):
        raise ValueError(f"{len(asked)} texts were sent, {len(answers)} {what} came back")
    return answers
