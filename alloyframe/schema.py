"""Schemas and fixed values of the material-property model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TEXT = ("material_class", "material_type", "material_name", "material_abbreviation", "trade_grade", "manufacturer", "section", "property_name", "value", "unit", "english", "test_condition", "comments")

#: One row for each measured property of a material; every measure is text. `_ord` is the order of arrival.
PROPERTY_FACT = T.StructType([*(T.StructField(c, T.StringType()) for c in _TEXT), T.StructField("_src", T.StringType()), T.StructField("_ord", T.LongType())])

#: What an extractor says about one document.
EXTRACTION = (
    "material_name string, material_abbreviation string, trade_grade string, manufacturer string, mechanical_properties array<struct<"
    "section:string, property_name:string, value:string, unit:string, english:string, test_condition:string, comments:string>>"
)

#: The answer of a language model around that.
ENVELOPE = "candidates array<struct<content:struct<parts:array<struct<text:string>>>>>"

#: Labels of the three property files, and the class that each holds.
FILE_CLASSES = {"Composites": "Composite", "Polymers": "Polymer", "Fibers": "Fiber"}

#: Strings that the CSV reader takes for null.
CSV_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

#: Substrings of an abbreviation that name a matrix and a fiber; the first that is found counts.
MATRIX_KEYS = (
    ("epoxy", "Epoxy"), ("cyanate ester", "Cyanate Ester"), ("cynate ester", "Cyanate Ester"), ("polypropylene", "Polypropylene"), ("pp", "Polypropylene"), ("peek", "PEEK"), ("pei", "PEI"), ("nylon", "Nylon"),
    ("pa6", "PA6"), ("polyester", "Polyester"), ("vinyl ester", "Vinyl Ester"), ("phenolic", "Phenolic"),
)
FIBER_KEYS = (
    ("carbon", "Carbon Fiber"), ("glass", "Glass Fiber"), ("e-glass", "E-Glass Fiber"), ("s-glass", "S-Glass Fiber"), ("aramid", "Aramid Fiber"), ("kevlar", "Kevlar Fiber"), ("basalt", "Basalt Fiber"), ("natural", "Natural Fiber"),
)

#: Properties and the words in a caption that speak of them.
CAPTION_WORDS = (
    ("tensile modulus", ("tensile", "modulus", "young", "elastic")),
    ("tensile strength", ("tensile", "strength", "ultimate")),
    ("elongation at break", ("elongation", "strain", "break")),
    ("glass transition temperature", ("glass transition", "tg", "transition")),
    ("melting temperature", ("melting", "tm", "melt")),
    ("density", ("density", "specific gravity")),
    ("impact strength", ("impact", "izod", "charpy")),
    ("flexural modulus", ("flexural", "bending", "flex")),
    ("stress", ("stress", "strain")),
    ("thermal", ("thermal", "temperature", "heat")),
    ("crystallinity", ("crystallinity", "crystalline", "xrd")),
)
STOP_WORDS = ("the", "of", "at", "in", "a", "an")

#: How a caption begins, and words that speak of stress and strain; white space, digits and word ends are
#: Unicode's, and so are letters of either case.
CAPTION = r"(?iU)^(Fig\.?\s*\d+|Figure\s*\d+)\b"
PLOT_WORDS = r"(?iU)(stress\s*[-–]?\s*strain|stress|strain|tensile|MPa|GPa|kN|yield|elongation)"

#: Property names by class and category, in the order in which a form offers them.
TAXONOMY = {
    "Polymer": {
        "Thermal": ("Glass transition temperature (Tg)", "Melting temperature (Tm)", "Crystallization temperature (Tc)", "Degree of crystallinity", "Decomposition temperature"),
        "Mechanical": ("Tensile modulus", "Tensile strength", "Elongation at break", "Flexural modulus", "Impact strength"),
        "Processing": ("Melt flow index (MFI)", "Processing temperature", "Cooling rate", "Mold shrinkage"),
        "Physical": ("Density", "Specific gravity"),
        "Descriptive": ("Material grade", "Manufacturer"),
    },
    "Fiber": {
        "Mechanical": ("Tensile modulus", "Tensile strength", "Strain to failure"),
        "Physical": ("Density", "Fiber diameter"),
        "Thermal": ("Decomposition temperature",),
        "Descriptive": ("Fiber type", "Surface treatment"),
    },
    "Composite": {
        "Mechanical": ("Longitudinal modulus (E1)", "Transverse modulus (E2)", "Shear modulus (G12)", "Poissons ratio (V12)", "Tensile strength (fiber direction)", "Interlaminar shear strength"),
        "Thermal": ("Glass transition temperature (matrix)", "Coefficient of thermal expansion (CTE)"),
        "Processing": ("Curing temperature", "Curing pressure"),
        "Physical": ("Density",),
        "Descriptive": ("Laminate type",),
        "Composition / Reinforcement": ("Fiber volume fraction", "Fiber weight fraction", "Fiber type", "Matrix type"),
        "Architecture / Structure": ("Weave type", "Ply orientation", "Number of plies", "Stacking sequence"),
    },
}


def taxonomy(spark: SparkSession) -> DataFrame:
    """(material_class, section, property_name, ord): 46 rows, so that a join may always broadcast it."""
    rows = [(c, s, p) for c, sections in TAXONOMY.items() for s, names in sections.items() for p in names]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "material_class string, section string, property_name string, ord int")
