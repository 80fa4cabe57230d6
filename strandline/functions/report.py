"""Expressions that a report needs: numbers as text, links, cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes of ontology ids and their place in the lookup service, tiers of traits, short names of metrics.
ONTOLOGIES = {"EFO": "efo", "HP": "hp", "ORPHANET": "ordo", "ORPHA": "ordo", "DOID": "doid", "NCIT": "ncit", "GO": "go", "OBA": "oba"}
TIERS = {"core": ("core",), "extended": ("core", "extended"), "all": ("core", "extended", "gated"), "gated": ("gated",)}
METRIC_LABELS = {"AUROC": "AUROC", "C-index": "C-idx", "R2": "R²"}

#: Body systems by words in a trait's name, of which the first in this order decides, and the systems' names.
BODY_SYSTEMS = (
    ("cancer", ("cancer", "carcinoma", "melanoma", "myeloma", "lymphoma", "leukemia")),
    ("endo", ("thyroid",)),
    ("metab", ("diabetes", "hba1c", "cholesterol", "lipoprotein", "hdl", "ldl", "glucose", "gout", "triglyceride", "c-reactive", "liver")),
    ("neuro", ("parkinson", "alzheimer", "dementia", "multiple sclerosis", "migraine", "depress", "bipolar", "schizo", "autism", "adhd", "intelligence", "cognitive", "educational", "neuroticism", "chronotype", "loneliness")),
    ("cardio", ("coronary", "atrial", "hypertension", "heart", "venous thrombo", "stroke", "aortic", "aneurysm", "arterial", "blood pressure", "systolic")),
    ("resp", ("chronic obstructive", "pulmonary", "copd", "asthma", "apnea")),
    ("msk", ("rheumatoid", "osteoarthritis", "osteoporosis", "ankylosing", "arthritis", "bone")),
    ("gut", ("inflammatory bowel", "coeliac", "celiac", "crohn", "colitis", "gallstone", "gallbladder")),
    ("msk", ("lupus",)),
    ("renal", ("kidney", "renal", "glomerular", "egfr")),
    ("eye", ("macular", "cataract", "glaucoma")),
    ("skin", ("dermatitis", "atopic", "psoriasis", "eczema")),
    ("anthro", ("height", "body mass", "waist")),
)
SYSTEM_NAMES = {
    "neuro": "brain / nervous system", "cardio": "heart / circulation", "resp": "lungs", "msk": "bones & joints", "metab": "blood sugar / lipids", "endo": "thyroid / hormones", "gut": "digestive tract",
    "eye": "eyes", "renal": "kidneys", "skin": "skin", "cancer": "cancer", "anthro": "body measure", "default": "general",
}


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))


def natural_frequency(x: Column) -> Column:
    """One in how many; null unless between 0 and 1."""
    return F.when((x > 0) & (x < 1), F.bround(1 / x).cast("bigint"))


def short_number(x: Column) -> Column:
    """A number with six digits that count, without zeros at its end; exponents below 1e-4 and from 1e6 on."""
    six = F.format_string("%.5e", x).cast("double")
    plain = F.regexp_replace(six.cast("decimal(30,12)").cast("string"), r"\.?0+$", "")
    power = F.regexp_replace(F.format_string("%.5e", x), r"\.?0*e", "e")
    return F.when(x == 0, "0").when((F.abs(six) >= 1e-4) & (F.abs(six) < 1e6), plain).otherwise(power)


def formatted(text: Column, percent: bool = False, default: str = "—") -> Column:
    """A field of a table for people: a dash where it is empty or NA, a number short or in percent, other text as it is."""
    x = text.try_cast("double")
    number = F.concat(F.bround(x * 100).cast("bigint").cast("string"), F.lit("%")) if percent else short_number(x)
    return F.when(text.isNull() | text.isin("", "NA"), default).when(x.isNotNull(), number).otherwise(text)


def ontology_url(term: Column) -> Column:
    """The page of an ontology term; null where there is none."""
    label = F.replace(term, F.lit("_"), F.lit(":"))
    slug = F.element_at(_map(ONTOLOGIES), F.upper(F.split_part(term, F.lit("_"), F.lit(1))))
    local = F.substring_index(term, "_", -1)
    page = F.when(term.startswith("MONDO_"), F.concat(F.lit("https://monarchinitiative.org/"), label)).when(
        slug.isNotNull() & F.contains(term, F.lit("_")) & local.rlike("^[0-9]+$"), F.concat(F.lit("https://www.ebi.ac.uk/ols4/ontologies/"), slug, F.lit("/classes?obo_id="), label)
    ).otherwise(F.concat(F.lit("https://www.ebi.ac.uk/ols4/search?q="), term))
    return F.when(term.isNull() | term.isin("", "NA", "—"), None).otherwise(page)


def performance_cell(metric: Column, value: Column) -> Column:
    """A reported metric in short; a dash where there is none."""
    return F.when(value.isNotNull(), F.concat_ws(" ", F.coalesce(F.element_at(_map(METRIC_LABELS), metric), metric), value.cast("string"))).otherwise("—")


def ancestry_text(samples: Column) -> Column:
    """The broad ancestries of nested samples, one after the other; unknown ones are empty."""
    return F.array_join(F.transform(samples, lambda s: F.coalesce(s["ancestry_broad"], F.lit(""))), " ")


def in_tier(tier: Column, wanted: str) -> Column:
    """Whether a trait of a tier is among those asked for; an unknown wish is the extended one."""
    return tier.isin(*TIERS.get(wanted, TIERS["extended"]))


def body_system(trait: Column) -> Column:
    """The body system of a trait's name; "default" where no word of the list is in it, or there is none."""
    return F.coalesce(*(F.when(F.lower(trait).rlike("|".join(words)), F.lit(system)) for system, words in BODY_SYSTEMS), F.lit("default"))


def system_name(system: Column) -> Column:
    return F.element_at(_map(SYSTEM_NAMES), system)
