"""Hand-made documents."""

import json


def frame(stamp, golds=None):
    """A frame; participant i holds 100*i unless ``golds`` says otherwise."""
    golds = {i: 100 * i for i in range(1, 11)} if golds is None else golds
    return {
        "timestamp": stamp,
        "participantFrames": {str(i): {"totalGold": g} for i, g in golds.items()},
    }


def without(*missing):
    return {i: 100 * i for i in range(1, 11) if i not in missing}


def timeline(match_id, *frames):
    return {"metadata": {"matchId": match_id}, "info": {"frames": list(frames)}}


POSITIONS = ("TOP", "JUNGLE", "MIDDLE", "BOTTOM", "UTILITY")


def participant(number, win, **more):
    base = {
        "participantId": number,
        "teamId": 100 if number <= 5 else 200,
        "teamPosition": POSITIONS[(number - 1) % 5],
        "win": win,
        "kills": number,
        "assists": 10 - number,
        "goldEarned": 1000 * number,
        "totalDamageDealtToChampions": 100 * number,
        "visionScore": 2 * number,
        "wardsPlaced": number % 4,
        "timeCCingOthers": 5 * number,
        "dragonKills": number % 2,
        "baronKills": number % 3,
        "challenges": {
            "soloKills": number % 5,
            "turretPlatesTaken": number % 4,
            "riftHeraldTakedowns": number % 2,
            "effectiveHealAndShielding": 1.5 * number,
        },
    }
    return {**base, **more}


def match(match_id, start_ms, blue_wins=True, numbers=range(1, 11), change=None):
    change = change or (lambda i: {})
    return {
        "metadata": {"matchId": match_id},
        "info": {
            "gameDuration": 1800,
            "gameStartTimestamp": start_ms,
            "participants": [
                participant(i, (i <= 5) == blue_wins, **change(i)) for i in numbers
            ],
        },
    }


def write(folder, **documents):
    """One file per document, as they are collected."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, document in documents.items():
        (folder / f"{name}.json").write_text(
            document if isinstance(document, str) else json.dumps(document)
        )
    return str(folder)
