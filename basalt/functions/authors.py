"""Author names: an ordered token rule that needs a loop, as an Arrow-batched UDF."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words that the rule removes or treats as connectors.
NOISE = (
    "nomen nudum", "nomen dubium", "originally", "vide", "preoccupied", "in part", "sic", "nomen rejectum",
    "nomen conservandum", "conserved name", "rejected name", "synonyms", "list", "of", "from",
)
CONNECTORS = ("&", "and", "in", "von", "de", "van", "da", "der")
# End of fixed values.

_NOISE = re.compile("|".join(map(re.escape, NOISE)), re.IGNORECASE)


def _without(text: str, own: str) -> str:
    return re.sub(rf"\b{re.escape(own)}\b", "", text, flags=re.IGNORECASE)


@lru_cache(8192)
def clean_author(raw: str | None, genus: str | None = None, species: str | None = None) -> str:
    """The author's part of a citation, '-' if nothing is left.

    Noise is removed as substrings, inside names too, but not inside the genus or species, which are removed as words; of equal
    names the later goes, unless it stands after 'and' or '&'."""
    if not raw or raw == "-":
        return "-"
    text = re.sub(r"\[.*?\]", "", raw)
    _, mark, tail = re.sub("emend", "\0", text, flags=re.IGNORECASE).rpartition("\0")
    text = re.sub(r"\d", "", re.sub(r"\d{4}[a-z]?", "", tail.lstrip(".") if mark else text))
    owns = [own for own in (genus, species) if own and own != "-"]
    # a name that holds noise isn't known any more once the noise is gone
    for own in owns:
        if _NOISE.search(own):
            text = _without(text, own)
    if _NOISE.search(text):
        for phrase in NOISE:
            text = re.sub(re.escape(phrase), "", text, flags=re.IGNORECASE)
    for own in owns:
        text = _without(text, own)
    kept: list[str] = []
    names: set[str] = set()
    joined = others = False
    for token in text.translate(str.maketrans("", "", '†"()?')).split():
        bare = token.rstrip(",. ")
        key = bare.lower()
        if key in ("et", "al", "etal"):
            if not others:
                kept.append("et al.")
            others = True
        elif key in CONNECTORS or any(c.isupper() for c in bare):
            if key in CONNECTORS or joined or key not in names:
                kept.append(token)
                names.add(key)
        joined = key in ("&", "and")
    out = " ".join(kept).replace(" ,", ",").strip(" ,.")
    out = re.sub(r"(et al\.?)(\s+et al\.?)+", r"\1", out)
    if out.endswith("et al"):
        out += "."
    return out if len(out) > 1 else "-"


clean_author_udf = F.udf(clean_author, T.StringType(), useArrow=True)
