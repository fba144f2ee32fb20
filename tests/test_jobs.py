"""The command-line jobs, end to end on a few records."""

import json
import os
import subprocess
import sys

import pytest

from placewell.__main__ import PRINTED, deliver, main, parser
from placewell.plans.places import entity_clean
from placewell.plans.readings import INSTANT
from placewell.sources.tables import replace_table, stored_table
from placewell.streaming.latest import read_latest_state

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def write(folder, name, *records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in records)
    return f"{folder}/{name}"


def test_batch_jobs(spark, folder, capsys):
    inputs = {
        "business": {"business_id": "p1", "name": "A", "address": "x", "city": "Philadelphia",
                     "state": "PA", "postal_code": "1", "latitude": 1.0, "longitude": 2.0,
                     "stars": 4.5, "review_count": 3, "is_open": 1, "categories": "Pizza",
                     "attributes": {"wifi": "free"}, "hours": {"Monday": "9-5"}},
        "review": {"review_id": "r", "user_id": "u", "business_id": "p1", "stars": 4.0, "text": "t",
                   "useful": 1, "funny": 2, "cool": 3, "date": "2020-01-02 03:04:05"},
        "checkin": {"business_id": "p1", "date": "2020-01-01 10:00:00, 2020-01-02 10:00:00"},
    }
    for name, record in inputs.items():
        main(["land", write(folder, f"{name}.json", record), f"{folder}/landed/{name}",
              "--dataset", name])
        main(["ingest", f"{folder}/landed/{name}", f"{folder}/raw/{name}", "--dataset", name])
    # landed once more, the same rows reach the raw tables twice
    main(["land", f"{folder}/review.json", f"{folder}/landed/review", "--dataset", "review"])
    main(["ingest", f"{folder}/landed/review", f"{folder}/raw/review", "--dataset", "review"])
    main(["history", f"{folder}/raw/review"])
    assert capsys.readouterr().out.count("\tloaded\t") == 2
    main(["refresh", *[f"{folder}/raw/{n}" for n in inputs],
          "--location", f"{folder}/clean", "--checkin-lists"])
    counts = {t: stored_table(spark, f"{folder}/clean", t).count()
              for t in ("entity_clean", "regional_top", "review_clean", "checkin_events",
                        "checkin_summary")}
    assert counts == {"entity_clean": 1, "regional_top": 1, "review_clean": 1, "checkin_events": 2,
                      "checkin_summary": 1}
    # a process of its own, which shares no catalog with the refresh
    shown = subprocess.run(
        [sys.executable, "-m", "placewell", "check", f"{folder}/raw/business", f"{folder}/raw/review",
         "--location", f"{folder}/clean"],
        cwd=ROOT, capture_output=True, text=True, check=True, timeout=300).stdout
    assert "missing_postal_code" in shown and "2020-01-01 00:00:00" in shown


def test_reading_jobs(spark, folder, capsys):
    source = write(folder, "polls.json", *[
        {"coord": c, "polled_at": f"2026-03-06 21:0{m}:00",
         "business_id": "old", "response": {"flowSegmentData": {"currentSpeed": s, "freeFlowSpeed": 40}}}
        for c, m, s in (("1,2", 0, 10), ("3,4", 0, 20), ("1,2", 5, 30), ("5,6", 5, 40))])
    main(["land-readings", source, f"{folder}/landed", "--city", "X",
          "--point", "1,2=p1", "--point", "3,4=p2"])
    main(["ingest-readings", f"{folder}/landed", f"{folder}/raw"])
    main(["watch", f"{folder}/raw", f"{folder}/state"])
    main(["fold", f"{folder}/state"])
    main(["latest", f"{folder}/raw"])
    assert "p1" in capsys.readouterr().out
    place = {"business_id": "p1", "name": "A", "address": "x", "city": "Philadelphia", "state": "PA", "postal_code": "1",
             "latitude": 1.0, "longitude": 2.0, "stars": 4.5, "review_count": 3, "is_open": 1, "categories": "Pizza",
             "attributes": "", "hours": ""}
    replace_table(entity_clean(spark.createDataFrame([place])), f"{folder}/clean", "entity_clean")
    main(["top", f"{folder}/raw", "--location", f"{folder}/clean"])
    shown = capsys.readouterr().out
    assert "p1\tA\tx" in shown and "\t30\t40\t" in shown
    main(["compact", f"{folder}/raw"])
    assert "too few batches, 0 folders" in capsys.readouterr().out
    state = read_latest_state(spark, f"{folder}/state", "business_id", INSTANT)
    assert {(r.business_id, r.current_speed) for r in state.collect()} == {("p1", 30.0), ("p2", 20.0)}


def test_long_results_need_a_folder(spark, folder, capsys):
    with pytest.raises(SystemExit, match="--output"):
        deliver(spark.range(PRINTED + 1), None)
    deliver(spark.range(PRINTED), None)
    assert capsys.readouterr().out.count("\n") == PRINTED + 1
    deliver(spark.range(PRINTED + 1), f"{folder}/out")
    assert f"{PRINTED + 1} rows" in capsys.readouterr().out


@pytest.mark.parametrize("arguments", [[], ["land", "a", "b"], ["land", "a", "b", "--dataset", "x"]])
def test_wrong_arguments(arguments):
    with pytest.raises(SystemExit):
        parser().parse_args(arguments)
