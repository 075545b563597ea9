"""Two invented matches, and what is needed to land them."""

import json

NORTH, LAKE = (11, "Northgate"), (12, "Lakeside")
MOCK_GRID = [[column * 0.01 for column in range(12)] for _ in range(8)]
MATCH_ID = 4711

# Moves run along the middle line, so that distances to the goal can be read off: 105 - 0.875 x.
# index, period, minute, second, type, team, player, location, end location, outcome, xg
EVENTS = [
    (1, 1, 0, 0, "Half Start", NORTH, None, None, None, None, None),
    (2, 1, 3, 12, "Pass", NORTH, "Åsa Lind", [42.0, 40.0], [64.0, 40.0], None, None),
    (3, 1, 3, 14, "Ball Receipt*", NORTH, "Jörg Maas", [64.0, 40.0], None, None, None),
    (4, 1, 3, 15, "Carry", NORTH, "Jörg Maas", [64.0, 40.0], [72.0, 40.0], None, None),
    (5, 1, 8, 40, "Pass", LAKE, "Tomás Vidal", [24.0, 40.0], [48.0, 40.0], "Incomplete", None),
    (6, 1, 21, 5, "Shot", NORTH, "Åsa Lind", [104.0, 40.0], [120.0, 41.0, 1.2], "Saved", 0.15),
    (7, 1, 21, 6, "Goal Keeper", LAKE, "Ben Okafor", [2.0, 40.0], None, None, None),
    (8, 1, 33, 30, "Carry", LAKE, "Tomás Vidal", [56.0, 40.0], [48.0, 40.0], None, None),
    (9, 1, 46, 20, "Pass", NORTH, "Jörg Maas", [72.0, 40.0], [96.0, 40.0], None, None),
    (10, 1, 48, 0, "Half End", NORTH, None, None, None, None, None),
    (11, 2, 45, 0, "Half Start", LAKE, None, None, None, None, None),
    (12, 2, 52, 10, "Pass", LAKE, "Ben Okafor", [48.0, 40.0], [72.0, 40.0], None, None),
    (13, 2, 58, 45, "Shot", LAKE, "Tomás Vidal", [108.0, 40.0], [120.0, 40.0, 0.3], "Goal", 0.4),
    (14, 2, 70, 0, "Pass", LAKE, "Ben Okafor", [88.0, 40.0], [82.0, 40.0], None, None),
    (15, 2, 80, 30, "Shot", NORTH, "Åsa Lind", [96.0, 40.0], [120.0, 44.0, 2.9], "Off T", 0.05),
    (16, 2, 91, 5, "Pass", NORTH, "Åsa Lind", [64.0, 40.0], [88.0, 40.0], None, None),
    (17, 2, 94, 0, "Half End", NORTH, None, None, None, None, None),
]


def event(row):
    index, period, minute, second, kind, team, player, location, end, outcome, xg = row
    out = {
        "id": f"event-{index}", "index": index, "period": period,
        "timestamp": f"00:{minute}:{second:02d}.000", "minute": minute, "second": second,
        "type": {"id": 1, "name": kind}, "possession": index,
        "possession_team": {"id": team[0], "name": team[1]}, "play_pattern": {"id": 1, "name": "Regular Play"},
        "team": {"id": team[0], "name": team[1]},
    }
    if player:
        out["player"] = {"id": sum(map(ord, player)), "name": player}
    if location:
        out["location"] = location
    if index in (2, 9):
        out["related_events"] = [f"event-{index - 1}", f"event-{index + 1}"]
    detail = {}
    if end:
        detail["end_location"] = end
    if outcome:
        detail["outcome"] = {"id": 9, "name": outcome}
    if xg is not None:
        detail["statsbomb_xg"] = xg
    if detail:
        out[kind.lower()] = detail
    return out


def events():
    return [event(row) for row in EVENTS]


def text(rows=None):
    return json.dumps(rows if rows is not None else events(), indent=2, ensure_ascii=False)


def land(folder, match_id=MATCH_ID, content=None, name="events.json"):
    target = folder / f"match_id={match_id}"
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(content if content is not None else text(), encoding="utf-8")
    return str(folder)


# A match as Silver rows: index, period, minute, type, team, completed, progressive, moved, xt added, outcome, xg
SERVED = [
    (1, 1, 2, "Pass", 21, True, True, True, 0.05, None, None),
    (2, 1, 7, "Carry", 21, False, False, True, -0.03, None, None),
    (3, 1, 14, "Pass", 21, False, False, False, None, "Out", None),
    (4, 1, 14, "Pass", 21, True, False, True, 0.02, None, None),
    (5, 1, 28, "Shot", 21, False, False, False, None, "Goal", 0.42),
    (6, 1, 47, "Carry", 21, False, False, True, 0.01, None, None),
    (7, 2, 60, "Shot", 21, False, False, False, None, "Blocked", 0.07),
    (8, 2, 74, "Shot", 21, False, False, False, None, "Off T", 0.11),
    (9, 1, 4, "Pass", 22, True, False, True, 0.03, None, None),
    (10, 1, 11, "Carry", 22, False, False, True, 0.04, None, None),
    (11, 2, 49, "Pass", 22, False, False, False, None, "Incomplete", None),
    (12, 2, 83, "Pass", 22, True, True, True, 0.06, None, None),
    (13, 2, 92, "Carry", 22, False, False, True, -0.02, None, None),
]


def served(spark, schema, match_id=2002):
    rows = []
    for index, period, minute, kind, team, completed, progressive, moved, added, outcome, xg in SERVED:
        values = dict.fromkeys(schema.fieldNames())
        values.update(
            match_id=match_id, event_id=f"e{index}", event_index=index, period=period, minute=minute, second=0,
            event_type=kind, team_id=team, team_name={21: "Foundry", 22: "Meadow"}[team], outcome=outcome,
            shot_xg=xg, is_pass=kind == "Pass", is_carry=kind == "Carry", is_shot=kind == "Shot",
            is_completed_pass=completed, is_progressive_pass=progressive, is_successful_move=moved,
            progress_ratio=0.4 if progressive else 0.2, start_x=40.0, start_y=20.0,
            xt_start=0.2 if moved else None, xt_end=0.2 + added if moved else None, xt_added=added,
            xt_model_version="1.0", source_version=1, file_hash="a1b2c3",
        )
        rows.append(tuple(values[n] for n in schema.fieldNames()))
    return spark.createDataFrame(rows, schema)
