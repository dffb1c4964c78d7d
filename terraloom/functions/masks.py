"""Quality masks as column expressions: class lists, bit fields, confidence levels.

Null in a quality or band column means nodata. All results are plain expressions, so they stay inside code generation.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import to_column

#: Confidence fields of a quality word and their lowest bits, and the levels of such a field.
CONFIDENCE_FIELDS = {"cloud": 8, "cloud_shadow": 10, "snow": 12, "cirrus": 14}
CONFIDENCE_LEVELS = {"NO_CONFIDENCE": 0, "LOW": 1, "MEDIUM": 2, "RESERVED": 2, "HIGH": 3}
#: Shorter names that predicates may use.
CONFIDENCE_ALIASES = {"shadow": "cloud_shadow", "NONE": "NO_CONFIDENCE"}


@dataclass(frozen=True)
class Mask:
    clear: tuple[int, ...]
    nodata: int
    not_clear: tuple[int, ...] = ()
    saturated: tuple[int, ...] = ()
    saturated_band: str | None = None
    bits: bool = False
    confidence: str | None = None

    @classmethod
    def parse(cls, spec: dict) -> Mask:
        """From a parameter document; clear classes and nodata are required."""
        if "nodata" not in spec or spec["nodata"] is None:
            raise ValueError("the mask needs a nodata value")
        if "clear_data" not in spec:
            raise ValueError("the mask needs clear_data")
        return cls(
            tuple(spec["clear_data"]), spec["nodata"], tuple(spec.get("not_clear_data", ())), tuple(spec.get("saturated_data", ())),
            spec.get("saturated_band"), bool(spec.get("bits", False)), spec.get("confidence"),
        )


def bit_range(x: Column, start: int, end: int | None = None) -> Column:
    """The number in bits start to end (inclusive)."""
    width = (start if end is None else end) - start + 1
    if start < 0 or width < 1:
        raise ValueError("bits go from a start of at least 0 to an end not below it")
    return F.shiftright(x, start).bitwiseAND(F.lit((1 << width) - 1))


def bit_test(x: Column, bit: int) -> Column:
    """The bit's value in place (a power of two) or 0."""
    return x.bitwiseAND(F.lit(1 << bit))


def saturated(radsat: Column) -> Column:
    """True where any of bits 1 to 7 is set."""
    return bit_range(radsat, 1, 7) != 0


def confidence(x: Column) -> dict[str, Column]:
    return {name: bit_range(x, low, low + 1) for name, low in CONFIDENCE_FIELDS.items()}


def confidence_hit(x: Column, predicate: str) -> Column:
    """A predicate such as ``cloud == MEDIUM or shadow >= LOW`` over the confidence fields."""
    names = confidence(x) | {k: F.lit(v) for k, v in CONFIDENCE_LEVELS.items()}
    return to_column(predicate, names | {k: names[of] for k, of in CONFIDENCE_ALIASES.items()})


def qa_usable(x: Column, mask: Mask, oli: Column | None = None) -> Column:
    """Bit mode: some clear bit set, no not-clear bit set, the confidence predicate false; null is not usable.

    With ``oli``, bit 2 (cirrus) of rows that are not OLI doesn't count against them.
    """
    bad = F.lit(False)
    for b in mask.not_clear:
        hit = bit_test(x, b) != 0
        bad = bad | (hit & oli if oli is not None and b == 2 else hit)
    good = F.lit(False)
    for b in mask.clear:
        good = good | (bit_test(x, b) != 0)
    if mask.confidence:
        bad = bad | confidence_hit(x, mask.confidence)
    return F.coalesce(good & ~bad, F.lit(False))


def class_usable(q: Column, v: Column, mask: Mask, radsat: Column | None = None) -> Column:
    """Class mode: clear classes always; else not if not clear, saturated or nodata; unlisted classes are usable."""
    bad = q.isNull() | v.isNull() | q.isin(*mask.not_clear, *mask.saturated) if mask.not_clear or mask.saturated else q.isNull() | v.isNull()
    if radsat is not None:
        bad = bad | F.coalesce(saturated(radsat), F.lit(False))
    return F.coalesce(q.isin(*mask.clear), F.lit(False)) | ~F.coalesce(bad, F.lit(True))


def literal_mask(text: str) -> dict:
    """A mask document given on a command line: JSON, never executed."""
    found = json.loads(text.replace("'", '"').replace("True", "true").replace("False", "false").replace("None", "null"))
    if not isinstance(found, dict):
        raise ValueError("a mask is a document of names and values")
    return found


def clear_and_not(q: Column, mask: Mask, oli: Column | None = None) -> tuple[Column, Column]:
    """(clear, not clear) of a quality value for scene statistics; a null value is neither.

    Class mode: the listed classes. Bit mode: usable words are clear and all others are not.
    """
    if mask.bits:
        good = qa_usable(q, mask, oli)
        return good & q.isNotNull(), q.isNotNull() & ~good
    no = F.lit(False)
    return (q.isin(*mask.clear) if mask.clear else no), (q.isin(*mask.not_clear) if mask.not_clear else no)


def usable(q: Column, v: Column, mask: Mask, radsat: Column | None = None, oli: Column | None = None) -> Column:
    if not mask.bits:
        return class_usable(q, v, mask, radsat)
    ok = qa_usable(q, mask, oli) & v.isNotNull()
    return ok if radsat is None else ok & ~F.coalesce(saturated(radsat), F.lit(False))
