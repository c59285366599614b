"""Invented occurrence rows and the temperatures of their days.

Among them: areas just around the limits the filters use, two incidents of one day at one place, and
one incident that spans two days.
"""

COLUMNS = ("id TIPO FALSOALARME LAT LON AREATOTAL DHINICIO DHFIM DATAALERTA HORAALERTA DATAEXTINCAO HORAEXTINCAO").split()

# id, area, start, end, lat, lon
INCIDENTS = [
    ("F-11", "0.2", "04-03-2013 09:15:00", "04-03-2013 10:05:00", "40.125", "-7.5"),
    ("F-12", "0.004", "12-04-2013 16:40:00", "12-04-2013 17:00:00", "40.25", "-7.75"),
    ("F-13", "0.03", "20-05-2013 11:00:00", "20-05-2013 11:30:00", "40.375", "-8.125"),
    ("F-21", "0.75", "01-06-2013 21:10:00", "01-06-2013 23:50:00", "40.5", "-8.25"),
    ("F-22", "0.02", "03-06-2013 08:05:00", "03-06-2013 08:25:00", "40.625", "-8.375"),
    ("F-23", "0.006", "03-06-2013 14:45:00", "03-06-2013 14:55:00", "40.625", "-8.375"),
    ("F-24", "14", "10-06-2013 18:30:00", "11-06-2013 03:20:00", "40.75", "-8.5"),
    ("F-25", "0.09", "22-06-2013 13:35:00", "22-06-2013 14:10:00", "40.875", "-8.625"),
]


def occurrences(spark):
    rows = [(i, "Florestal", "0", lat, lon, area, a, b, None, None, None, None) for i, area, a, b, lat, lon in INCIDENTS]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS))


# date, lat, lon, max, min
WEATHER = [
    ("2013-03-04", 40.125, -7.5, 14.5, 5.25),
    ("2013-04-12", 40.25, -7.75, 19.0, 8.5),
    ("2013-05-20", 40.375, -8.125, 22.25, 10.75),
    ("2013-06-01", 40.5, -8.25, 24.5, 12.0),
    ("2013-06-03", 40.625, -8.375, 26.0, 13.5),
    ("2013-06-10", 40.75, -8.5, 30.5, 16.25),
    ("2013-06-11", 40.75, -8.5, 28.0, 15.25),
    ("2013-06-22", 40.875, -8.625, 27.75, 14.0),
]
