"""Stand-in fetch functions and a receiver for the sources and sinks; nothing leaves the machine."""

from pathlib import Path
from uuid import uuid4

from vejrkraft.sinks.messages import Refused


def page(parameter, offset, limit):
    if parameter == "broken" and offset > 0:
        raise OSError("no answer")
    total = {"bright_sunshine": 5, "mean_radiation": 4, "broken": 9}[parameter]
    rows = range(offset, min(offset + limit, total))
    return {"features": [{"properties": {"stationId": f"0{i}", "value": i}} for i in rows]}


def document():
    return '{"id": 208, "name": "x"}'


def failing():
    raise OSError("no answer")


class Receiver:
    """Keeps messages in a folder; fails the first task that brings one named in ``fail_on``, refuses others by name."""

    def __init__(self, options):
        self.folder, self.options = Path(options["box"]), options
        self.folder.mkdir(parents=True, exist_ok=True)
        self.out = open(self.folder / f"{uuid4().hex}.txt", "w")

    def send(self, topic, value):
        marker = self.folder / f"{value}.failed"
        if value in self.options.get("fail_on", "").split(",") and not marker.exists():
            marker.write_text("")
            raise ConnectionError("gone")
        if value == self.options.get("refuse"):
            raise Refused("not wanted")
        self.out.write(f"{topic}:{value}\n")

    def close(self):
        self.out.close()
