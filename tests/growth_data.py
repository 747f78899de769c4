"""Published example measurements: days and grams.  Fixed values."""

HOLCUS_X = [7, 7, 7, 14, 14, 14, 21, 21, 21, 28, 28, 28, 42, 42, 42, 56, 56, 56, 70, 70, 83, 70, 83, 83]
HOLCUS_Y = [
    0.000442, 0.000498, 0.000512, 0.002286, 0.002692, 0.00306, 0.0117, 0.0203, 0.0216, 0.0514, 0.0646, 0.0936,
    0.891, 0.91, 1.173, 4.775, 4.95, 6.082, 11.156, 11.35, 12.539, 13.712, 15.07, 15.58,
]
CERASTIUM_X = [14, 14, 14, 35, 35, 35, 70, 133, 70, 161, 98, 161, 133, 98, 189, 189, 189, 98, 133, 161]
CERASTIUM_Y = [
    0.031, 0.087, 0.09, 0.261, 0.291, 0.437, 2.104, 2.736, 2.814, 5.832, 2.979, 9, 6.309, 3.483, 6.103, 5.655,
    5.889, 4.462, 8.392, 7.043,
]
GERANIUM_X = [14, 14, 14, 70, 70, 35, 35, 35, 189, 133, 161, 70, 189, 189, 133, 161, 133, 98, 98, 98]
GERANIUM_Y = [
    1.125, 1.517, 2.667, 2.875, 4.668, 5.862, 5.469, 6.702, 4.331, 9.404, 11.712, 10.392, 7.602, 8.897, 10.055,
    17.204, 14.298, 10.078, 8.19, 11.075,
]
SEED_MASS = 0.00045


def series(spark, *named):
    data = {
        "holcus": (HOLCUS_X, HOLCUS_Y),
        "CER": (CERASTIUM_X, CERASTIUM_Y),
        "GER": (GERANIUM_X, GERANIUM_Y),
    }
    rows = [(name, float(x), float(y)) for name in named for x, y in zip(*data[name])]
    return spark.createDataFrame(rows, "g string, x double, y double")
