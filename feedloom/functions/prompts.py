"""Texts sent to models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from feedloom.schemas import CATEGORIES, SENTIMENTS


@dataclass(frozen=True)
class Persona:
    """A reader of reports; ``template`` holds ``{context}`` where the figures go."""

    name: str
    label: str
    template: str


PERSONAS = (
    Persona(
        "community_manager",
        "Community Manager",
        "You advise the person who looks after a game's community. Using nothing but the "
        "figures and quotes below, open with a short summary of the mood and its causes. Then "
        "describe how friendly or hostile players are to each other, what they praise, what "
        "they ask for, and what makes them leave.\n\n{context}",
    ),
    Persona(
        "marketer",
        "Marketer",
        "You advise the person who promotes a game. Using nothing but the figures and quotes "
        "below, open with a short summary of the mood and its causes. Then name the features "
        "players like best, the words they use for them, what brings them back, and what "
        "drives them away.\n\n{context}",
    ),
    Persona(
        "game_designer",
        "Game Designer",
        "You advise the person who designs a game. Using nothing but the figures and quotes "
        "below, open with a short summary of the mood and its causes. Then list the mechanics "
        "players like and dislike most, steps that confuse newcomers, and anything that feels "
        "unfair or is being exploited.\n\n{context}",
    ),
)


def extraction_prompt(categories: Sequence[str] = CATEGORIES) -> str:
    """Directions for the extraction model; the text of the item follows them."""
    allowed = ", ".join(SENTIMENTS)
    fields = [
        '"overall": sentiment of the whole text or null',
        '"summary": what drives the sentiment, in at most ten words',
        *[f'"{c}": {{"sentiment": …, "sub_topic": …}} or null' for c in categories],
        '"other": [{"topic": …, "sentiment": …}] for anything that fits no key above',
    ]
    return (
        "Read the player's text and answer with one JSON object, no markup around it. "
        f"A sentiment is one of {allowed}. Keys:\n" + "\n".join(fields) + "\nText:\n"
    )
