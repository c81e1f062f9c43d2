"""Hand-written lookup responses and the rows they must give."""

from aerostar.sources import flatten_hotel_pages, parse_hotel_pages, reject_hotel_pages

DOCS = [
    ('{"page": 1, "results": {"location": {"cityName": "Hue", "countryName": "VN", "countryCode": "V", "iata": "HUI", "hotelsCount": 2}, '
     '"hotels": [{"id": "7", "label": "Old \\"Inn\\"", "locationName": "L", "fullName": "F", "locationId": "9", "location": {"lat": 1.5, "lon": -2.0}}, {"id": "8"}]}}'),
    '{"page": 2, "results": {"hotels": [{"id": "9", "location": {"lat": 3.0}}]}}',
    '{"page": 3, "results": {"location": {"cityName": null}, "hotels": []}}',
    '{"page": 4, "results": {}}',
    '{"page": 5}',
    "{broken",
    None,
    "",
]
ROWS = [
    ("7", 'Old "Inn"', "L", "F", "9", "Hue", "VN", "V", "HUI", 1.5, -2.0, 2),
    ("8", None, None, None, None, "Hue", "VN", "V", "HUI", None, None, 2),
    ("9", None, None, None, None, "", "", "", "", 3.0, None, 0),
]


def test_rows_and_rejects(spark):
    docs = spark.createDataFrame([(d,) for d in DOCS], "json string")
    assert sorted(map(tuple, flatten_hotel_pages(parse_hotel_pages(docs)).collect()), key=repr) == sorted(ROWS, key=repr)
    assert sorted((r.json for r in reject_hotel_pages(docs).collect()), key=repr) == sorted(["{broken", None, ""], key=repr)
    assert parse_hotel_pages(docs).count() + reject_hotel_pages(docs).count() == len(DOCS)
