"""A transport whose index takes no value above 2.5."""

import json

from airstrata.sinks.index_source import FolderIndex


class Picky(FolderIndex):
    def send(self, staged, pairs):
        errors = [None if json.loads(body)["valeur"] <= 2.5 else f"{key} is too high" for key, body in pairs]
        super().send(staged, [p for p, e in zip(pairs, errors) if e is None])
        return errors
