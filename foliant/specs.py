"""What is known about venues before any data is read."""

from __future__ import annotations

from dataclasses import dataclass, field

# The sources of each venue and how a site is read. cards and tables are page layouts, browser pages need
# rendering, stub sites have no pages to read.
VENUES: dict[str, dict[str, str]] = {
    "iclr": {"platform": "api", "site": "cards"},
    "nips": {"platform": "api", "site": "cards", "form": "sheet"},
    "icml": {"platform": "api", "site": "cards", "form": "sheet"},
    "corl": {"platform": "api", "site": "stub"},
    "colm": {"platform": "api", "site": "stub"},
    "emnlp": {"platform": "api", "site": "stub", "form": "sheet"},
    "acl": {"platform": "api", "site": "stub", "form": "sheet"},
    "cvpr": {"site": "cards from 2023, else tables", "openaccess": "pages", "form": "sheet"},
    "eccv": {"site": "cards from 2024, else tables", "openaccess": "pages", "form": "sheet"},
    "iccv": {"site": "cards from 2024, else tables", "openaccess": "pages"},
    "wacv": {"site": "tables", "openaccess": "pages", "form": "sheet"},
    "siggraph": {"site": "browser"},
    "siggraphasia": {"site": "browser"},
    "kdd": {"site": "stub", "form": "sheet"},
    "uai": {"site": "stub", "form": "sheet"},
    "aaai": {"site": "stub", "form": "sheet"},
    "acmmm": {"platform": "api", "site": "stub", "form": "sheet"},
    "www": {"platform": "api", "form": "sheet"},
    "arr": {"platform": "api", "form": "sheet"},
    "aistats": {"platform": "api"},
    "scholar": {"site": "browser"},
}


def source_kind(venue: str, source: str, year: int) -> str | None:
    """How a venue's source is read in a year; None if it has none. An unknown venue is a KeyError."""
    kind = VENUES[venue].get(source)
    if kind and " from " in kind:
        new, _, rest = kind.partition(" from ")
        since, _, old = rest.partition(", else ")
        return new if year >= int(since) else old
    return kind


@dataclass(frozen=True)
class FormSpec:
    """How the responses of a venue's survey become papers."""

    dimensions: dict[str, str]  # dimension -> column of the initial score, the main one first
    id_column: str | None = None  # None: the row's number
    status_column: str | None = None  # None: Active
    area_column: str | None = None
    track_column: str | None = None
    first_column: str | None = None  # "submitting this form for the first time?"
    consent_column: str | None = None
    cjk: bool = True  # whether CJK signs, too, make a main score invalid
    enforce: bool = True  # whether invalid main scores are dropped
    cap: float | None = None
    cap_inclusive: bool = False
    cap_action: str = "skip"
    equal_lengths: tuple[str, str] | None = None
    suffix: str = "after Rebuttal"


# What differs between venues' forms. cap: the largest average that counts; equal_lengths: places of two
# dimensions that have to have as many scores.
FORM_RULES: dict[str, dict] = {
    "icml": {"cjk": False, "equal_lengths": (0, 1)},
    "acl": {"cjk": False, "cap": 5},
    "arr": {"cjk": False, "cap": 5},
    "kdd": {"cjk": False, "cap": 4, "cap_action": "raise", "equal_lengths": (0, 2)},
    "uai": {"cjk": False, "equal_lengths": (0, 1)},
    "eccv": {"cap": 5},
    "acmmm": {"cap": 6},
    "emnlp": {"cap": 6},
    "nips": {"cap": 10, "cap_inclusive": True},
    "wacv": {"cap": 5, "suffix": "after Revision"},
    "aaai": {"cjk": False, "equal_lengths": (0, 1)},
    "cvpr": {"cap": 5},
    "www": {"cap": 5},
}


def form_spec(venue: str, year: int, dimensions: dict[str, str], **columns) -> FormSpec:
    rules = dict(FORM_RULES[venue])
    if venue in ("icml", "arr") and year >= 2025:
        rules["enforce"] = False
    if venue == "kdd" and year <= 2024:
        rules["cap"] = 6
    places = rules.pop("equal_lengths", None)
    if venue == "icml" and year != 2024:
        places = None
    if places and max(places) < len(dimensions):
        rules["equal_lengths"] = tuple(list(dimensions)[i] for i in places)
    return FormSpec(dimensions, **rules, **columns)


@dataclass(frozen=True)
class MergePolicy:
    """How matched and left-over rows of a venue become one list."""

    prefer_site: tuple[str, ...] = ()
    site_only: tuple[str, ...] = ("site",)
    drop_site_leftovers: bool = False
    rename: dict[str, str] = field(default_factory=dict)
    fixed_tiers: tuple[str, ...] = ()


MERGE_POLICIES: dict[str, MergePolicy] = {
    "iclr": MergePolicy(site_only=("site", "slides", "video"), drop_site_leftovers=True),
    "nips": MergePolicy(site_only=("site", "poster", "proceeding")),
    "icml": MergePolicy(site_only=("site", "poster")),
    "cvpr": MergePolicy(rename={"video": "youtube"}, prefer_site=("status",)),
    "iccv": MergePolicy(rename={"video": "youtube"}, prefer_site=("status",)),
    "emnlp": MergePolicy(fixed_tiers=("Long Main", "Short Main", "Long Findings", "Short Findings")),
    "siggraph": MergePolicy(fixed_tiers=("Poster", "Technical Paper")),
    "siggraphasia": MergePolicy(fixed_tiers=("Poster", "Technical Paper")),
}


def merge_policy(venue: str) -> MergePolicy:
    return MERGE_POLICIES.get(venue, MergePolicy())


#: Where a note's decision stands, by venue and first year of the rule, latest first.
STATUS_SOURCES: dict[str, list[tuple[int, str]]] = {
    "iclr": [(2024, "venue"), (2015, "reply_decision"), (2013, "note_decision")],
    "nips": [(2021, "venue")],
    "icml": [(2023, "venue")],
    "corl": [(2021, "venue")],
    "colm": [(2024, "venue")],
    "emnlp": [(2023, "type_plus_decision")],
}


def status_source(venue: str, year: int) -> str:
    for since, kind in STATUS_SOURCES.get(venue, []):
        if year >= since:
            return kind
    return "venue"
