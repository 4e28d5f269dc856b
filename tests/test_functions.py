import numpy as np
import pytest
from pyspark.sql import functions as F

from alloyframe.functions import boxes, classify, pixels, text, vectors
from alloyframe.functions.json import envelope_text, extraction


def values(spark, rows, kind, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_classes(spark):
    rows = ["Carbon/Epoxy", "E-Glass/PP", "CF/PPS", "Nylon PA6 Kevlar", "Basalt Vinyl Ester", "Cynate Ester S-glass", "copper", "", None]
    assert values(spark, rows, "string", classify.matrix_of(F.col("x"))) == ["Epoxy", "Polypropylene", "Polypropylene", "Nylon", "Vinyl Ester", "Cyanate Ester", "Polypropylene", None, None]
    assert values(spark, rows, "string", classify.fiber_of(F.col("x"))) == ["Carbon Fiber", "Glass Fiber", None, "Kevlar Fiber", "Basalt Fiber", "Glass Fiber", None, None, None]
    assert values(spark, ["E-Glass/PP"], "string", classify.fiber_of(F.col("x"), "longest_match")) == ["E-Glass Fiber"]
    with pytest.raises(ValueError):
        classify.matrix_of(F.col("x"), "other")


def test_abbreviation(spark):
    rows = ["isotactic polypropylene", "6061 alloy", "(x) beta", "123 456", "  ", "", None, "élan vital"]
    assert values(spark, rows, "string", text.abbreviation(F.col("x"))) == ["IP", "A", "B", "123 45", "  ", "UNKNOWN", "UNKNOWN", "ÉV"]


def test_captions(spark):
    rows = ["Fig. 3 x", "FIGURE 12: y", "Fig3", "Figs 3", "Fig 3a", "Figure 12b", "see Fig 1", None]
    assert values(spark, rows, "string", text.is_caption(F.col("x"))) == [True, True, True, False, False, False, False, None]


@pytest.mark.parametrize(
    ("caption", "prop", "fits"),
    [
        ("Figure 3: Young's response", "Tensile modulus", True),
        ("Fig. 2 Load history", "Tensile modulus", False),
        ("Fig 4 DSC melting curve", "Melting temperature (Tm)", True),
        ("Fig 5 heat treatment", "Melting temperature (Tm)", True),
        ("Figure 1 fiber volume vs fraction", "Fiber volume fraction", True),
        ("Fig 1 effect of the modulus in shear", "Shear modulus (G12)", True),
        ("Fig 2 density map", "Specific gravity", False),
    ],
)
def test_caption_fits(spark, caption, prop, fits):
    df = spark.createDataFrame([(caption, prop)], "c string, p string")
    assert df.select(text.caption_fits(F.col("c"), F.col("p"))).first()[0] is fits


def test_small_text(spark):
    assert values(spark, ["\t a \n", " b "], "string", text.strip(F.col("x"))) == ["a", "b"]
    assert values(spark, ["/x/My paper.v2.pdf", "/x/nodot"], "string", text.file_stem(F.col("x"))) == ["My_paper.v2", "nodot"]
    assert values(spark, ["", None, "v"], "string", text.or_default(F.col("x"), "N/A")) == ["N/A", "N/A", "v"]


def test_answers(spark):
    good = '{"candidates":[{"content":{"parts":[{"text":"hm"},{"text":" {\\"material_name\\":\\"m\\",\\"mechanical_properties\\":[]}"}]}}]}'
    rows = [good, '{"candidates":[{"content":{"parts":[{"text":"{broken"}]}}]}', '{"candidates":[]}', "x", None]
    got = values(spark, rows, "string", extraction(envelope_text(F.col("x"))))
    assert got[0].material_name == "m" and got[1:] == [None] * 4


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    got = df.select(vectors.squared_distance(F.col("a"), F.col("b")).alias("d"), F.round(vectors.cosine(F.col("a"), F.col("b")), 9).alias("c")).collect()
    assert [tuple(r) for r in got] == [(5.0, 0.0), (2.0, 1.0), (2.0, 0.0)]


def test_suppress_contained(spark):
    df = spark.createDataFrame([([(0, 0, 100, 100, 0), (10, 10, 20, 20, 1), (200, 0, 9, 9, 2)],), ([],)], "b array<struct<x:int,y:int,w:int,h:int,ord:int>>")
    got = [sorted(b.ord for b in r[0]) for r in df.select(boxes.suppress_contained(F.col("b"))).collect()]
    assert got == [[0, 2], []]


def test_crops(spark):
    one = spark.range(1)
    cut = lambda *v: one.select(boxes.safe_crop(*map(F.lit, v)).alias("b")).first()[0]
    assert tuple(cut(50, 40, 10, 5, 30, 30)) == (10, 5, 30, 30)
    assert cut(40, 0, 50, 10, 30, 30) is None
    assert tuple(one.select(boxes.grown(*map(F.lit, (100, 100, 300, 200, 310, 900))).alias("b")).first()[0]) == (80, 94, 310, 218)


def test_difference_bits(spark):
    assert values(spark, [[2, 1, 3, 5, 4, 4]], "array<int>", boxes.difference_bits(F.col("x"), 3)) == [0b1010]


def drawn_plot():
    image = np.full((400, 500, 3), 255, np.uint8)
    image[350:353, 60:480] = 0
    image[20:353, 60:63] = 0
    for k in range(12):
        image[362:374, 75 + 33 * k : 83 + 33 * k] = 0
        image[30 + 26 * k : 42 + 26 * k, 30:38] = 0
    return image


def test_pixels(spark):
    image = drawn_plot()
    assert (pixels.decode_png(pixels.encode_png(image)) == image).all()
    assert pixels.real_plot(image)
    assert not pixels.real_plot(np.full((400, 500, 3), 255, np.uint8))
    page = np.full((1200, 1000, 3), 255, np.uint8)
    page[300:700, 200:700] = image
    assert len(pixels.page_boxes(page)) >= 1
    assert pixels.components(np.array([[1, 0], [0, 1]], bool))[1] == [(2, 0, 0, 2, 2)]
    assert len(pixels.components(np.array([[1, 0], [0, 1]], bool), corners=False)[1]) == 2
    assert pixels.thumbnail(np.full((40, 90), 77, np.uint8)).tolist() == [[77] * 9] * 8
    df = spark.createDataFrame([(pixels.encode_png(image),), (None,)], "png binary")
    levels = df.select(pixels.thumbnail_levels(F.col("png")).alias("levels"), pixels.is_real_plot(F.col("png")).alias("plot"))
    got = levels.select(boxes.difference_bits(F.col("levels"), 9), "plot").collect()
    assert got[0][1] is True and got[1][1] is None


def filtered_png(image, kinds):
    """A PNG whose rows are written with the given filters, pixel by pixel."""
    import struct
    import zlib

    h, w, d = image.shape
    rows = []
    for y in range(h):
        line = [kinds[y]]
        for x in range(w):
            for c in range(d):
                at = lambda yy, xx: int(image[yy, xx, c]) if yy >= 0 and xx >= 0 else 0  # noqa: B023, E731
                a, b, e = at(y, x - 1), at(y - 1, x), at(y - 1, x - 1)
                p = a + b - e
                near = min((abs(p - v), k, v) for k, v in enumerate((a, b, e)))[2]
                line.append((int(image[y, x, c]) - (0, a, b, (a + b) // 2, near)[kinds[y]]) % 256)
        rows.append(bytes(line))
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    colour = {1: 0, 3: 2, 4: 6}[d]
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + part(b"IDAT", zlib.compress(b"".join(rows))) + part(b"IEND", b"")


def test_png_filters():
    r = np.random.default_rng(3)
    for h, w, d in ((1, 1, 3), (7, 1, 1), (1, 9, 4), (12, 8, 3), (5, 17, 1)):
        image = r.integers(0, 256, (h, w, d), dtype=np.uint8)
        want = image[:, :, 0] if d == 1 else image[:, :, :3]
        for kinds in (*([k] * h for k in range(5)), r.integers(0, 5, h).tolist(), r.integers(0, 3, h).tolist()):
            assert (pixels.decode_png(filtered_png(image, kinds)) == want).all(), (h, w, d, kinds)


def test_captions_with_other_spaces(spark):
    texts = ["Fig.\u00a03 x", "FIGURE\u200312: y", "Fig \u0663", "Figs 3", "see Fig 1", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in df.select(text.is_caption(F.col("t"))).collect()] == [True, True, True, False, False, None]
    assert [r[0] for r in spark.createDataFrame([("STRESS\u00a0\u2013\u00a0strain",), ("load",)], "t string").select(text.speaks_of_a_plot(F.col("t"))).collect()] == [True, False]


def test_measures_of_plots():
    strip = np.full((200, 300, 3), 255, np.uint8)
    assert not pixels.colour_strip(strip) and pixels.colour_count(strip, 24) == 1
    r = np.random.default_rng(1).integers(0, 256, (200, 21, 3), dtype=np.uint8)
    strip[:, -21:] = r
    assert pixels.colour_strip(strip) and not pixels.colour_strip(strip[:100]) and not pixels.colour_strip(strip[:, :, 0])
    assert pixels.colour_count(r, 24) == len({tuple(x) for x in (r // 24).reshape(-1, 3).tolist()})
    assert pixels.tick_marks(drawn_plot(), 351, 61) >= 18
