import math
import random

from pyspark.sql import functions as F

from conftest import rows
from shelfmark.operators import geocode as g

HIT = '{"features": [{"geometry": {"coordinates": [2.308628, 48.850699]}, "properties": {"label": "20 Avenue", "score": 0.95, "city": "Paris", "postcode": "75007"}}]}'


def test_responses_and_join(spark):
    requests = spark.createDataFrame(
        [(1, " 20 Avenue ", "Paris", "75007"), (2, "20 avenue", "PARIS", "75007"), (3, "x", None, ""), (4, "y", None, None), (5, "z", "", None)],
        "id bigint, address string, city string, postcode string",
    )
    bodies = [("20 avenue|paris|75007", HIT), ("x", '{"features": []}'), ("y", '{"features": [{"geom')]
    answers = g.parse_responses(spark.createDataFrame(bodies, "key string, body string"))
    out = g.geocode(requests, answers)
    assert rows(out, "original_id", "latitude", "longitude", "error") == [
        (1, 48.850699, 2.308628, None), (2, 48.850699, 2.308628, None),
        (3, None, None, "not_found"), (4, None, None, "not_found"), (5, None, None, "not_found"),
    ]
    assert g.distinct_lookups(requests).count() == 4
    assert tuple(g.geocode_stats(requests, answers).first()) == (3, 1, 1, 2, 1)
    shops = spark.createDataFrame([(1, None), (3, 0.0)], "row_number bigint, latitude double")
    assert rows(g.enrich(shops, out), "row_number", "latitude") == [(1, 48.850699), (3, 0.0)]
    bronze = g.found_only(out, source="s", batch_id="b")
    assert bronze.count() == 2 and "coordinates" in bronze.first().result.raw_response


def test_request_address(spark):
    df = spark.createDataFrame([("20 avenue de Ségur", "Paris", "75007")], "a string, c string, p string")
    url = df.select(g.query_url("http://h/", F.col("a"), F.col("c"), F.col("p"))).first()[0]
    assert url == "http://h/?q=20%20avenue%20de%20S%C3%A9gur%20Paris%2075007&limit=1&postcode=75007"


def test_nearest_address_is_exact_anywhere(spark):
    rng = random.Random(3)
    # a dense city that holds a third of everything, copies, the date line, the poles
    places = [(i, 48.8 + rng.random() / 50, 2.3 + rng.random() / 50) for i in range(100)]
    places += [(200 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(100)]
    places += [(400, 0.0, 179.9), (401, 89.9, 10.0), (402, places[0][1], places[0][2])]
    points = [(i, 48.8 + rng.random() / 50, 2.3 + rng.random() / 50) for i in range(60)]
    points += [(100 + i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(100)]
    points += [(300, 0.1, -179.95), (301, 89.95, -170.0), (302, places[0][1], places[0][2])]

    def hav(p, q):
        a, b = math.radians(p[1]), math.radians(q[1])
        return math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2

    got = g.nearest_address(
        spark.createDataFrame(points, "point_id bigint, latitude double, longitude double"),
        spark.createDataFrame(places, "address_id bigint, latitude double, longitude double"),
    )
    found = {r.point_id: r.address_id for r in got.collect()}
    assert len(found) == len(points)
    for p in points:
        assert found[p[0]] == min(places, key=lambda q: (hav(p, q), q[0]))[0]


def test_repeated_answers_count_once(spark):
    asked = spark.createDataFrame([(1, "20 Avenue", "Paris", "75007")], "id bigint, address string, city string, postcode string")
    bodies = [("20 avenue|paris|75007", b) for b in ("broken", HIT, HIT, None)]
    answers = g.parse_responses(spark.createDataFrame(bodies, "key string, body string"))
    (found,) = g.geocode(asked, answers).collect()
    assert found.error is None and found.latitude is not None


def test_coarse_cells_move_no_points(spark):
    cells = [(i, float(i % 160 - 80), float(i * 7 % 340 - 170)) for i in range(50)]
    df = spark.createDataFrame(cells, "point_id long, latitude double, longitude double")
    spots = spark.createDataFrame(cells, "address_id long, latitude double, longitude double")
    out = g.nearest_address(df, spots)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    # no exchange between the windows of the coarse levels, whose points meet all cells of a level
    steps = [x for line in plan for x in ("Window [", "Exchange hashpartitioning", "BroadcastHashJoin") if x in line and "BroadcastExchange" not in line]
    assert any(steps[i : i + 4] == ["Window [", "BroadcastHashJoin"] * 2 for i in range(len(steps))), "\n".join(plan)
    got = {x.point_id: (x.address_id, x.distance_km) for x in out.collect()}
    assert all(got[i] == (i, 0.0) for i, _, _ in cells)
