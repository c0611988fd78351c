"""Chemical formulas as they are printed: one spelling for comparison, and whether named ions make them up.

Compatibility folding turns raised and lowered digits and signs into plain ones; nothing is read into a
formula, renamed or put in another order. All of it is SQL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import text as tx
from lodestone.functions.vocabulary import let

# The symbols of the elements.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr "
    "Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu "
    "Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr "
    "Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
)
# Sites in the order in which a formula names them; acronyms; a group with a whole factor at the end; a fraction in it.
SITES = ("A", "B", "X")
_ACRONYM = "^[A-Z]{2,}[A-Za-z0-9+-]*$"
_GROUP = r"^(.*?)\(([^()]*)\)\s*([0-9]+)\s*$"
_FRACTION = r"[A-Za-z]+0?\.[0-9]+"


def _plain(text: Column) -> Column:
    return F.replace(tx.nfkc(text), F.lit("−"), F.lit("-"))


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, "[^A-Za-z0-9.+-]+", "")


def formula_key(text: Column) -> Column:
    """What of a formula counts: letters, digits, points and signs. Null stays null."""
    return _bare(_plain(text))


def is_token(text: Column) -> Column:
    """Whether a text is the symbol of an element or an acronym (two capitals or more first); null is none."""
    return F.coalesce(text.isin(*ELEMENTS.split()) | text.rlike(_ACRONYM), F.lit(False))


def reported_spellings(text: Column) -> Column:
    """Array of the keys of a reported formula: its own and, if it ends with a bracket of two or more
    fractions and a whole factor, the one in which the bracket is opened and the factor left out. Null
    has none."""

    def spelled(own: Column) -> Column:
        part = lambda i: F.regexp_extract(own, f"(?s){_GROUP}", i)
        opened = F.size(F.regexp_extract_all(part(2), F.lit(_FRACTION), F.lit(0))) >= 2
        whole = F.array(_bare(own))
        return F.when(opened, F.array_union(whole, F.array(_bare(F.concat(part(1), part(2)))))).otherwise(whole)

    return F.when(text.isNotNull(), let(_plain(text), spelled)).otherwise(F.array().cast("array<string>"))


def ion_spellings(ions: Column) -> Column:
    """Array of the keys that ions (site, abbreviation, coefficient as text) make up, site by site in the
    order given: with all coefficients, and without those that are 1. Ions of other sites, or with a part
    that is null, are left out; a null array has none."""
    known = F.filter(ions, lambda x: x["abbreviation"].isNotNull() & x["coefficient"].isNotNull())
    at = lambda site: F.filter(known, lambda x: x["site"] == site)
    ordered = F.concat(*map(at, SITES))
    explicit = lambda x: F.concat(x["abbreviation"], x["coefficient"])
    implicit = lambda x: F.when(x["coefficient"] == "1", x["abbreviation"]).otherwise(explicit(x))
    keys = let(ordered, lambda own: F.array_distinct(F.array(*[formula_key(F.array_join(F.transform(own, form), "")) for form in (explicit, implicit)])))
    return F.when(ions.isNotNull(), keys).otherwise(F.array().cast("array<string>"))


def reconstructs(text: Column, ions: Column) -> Column:
    """Whether the ions make up the reported formula in one of its spellings; never of a null formula."""
    return F.arrays_overlap(reported_spellings(text), ion_spellings(ions))
