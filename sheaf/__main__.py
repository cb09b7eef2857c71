"""python -m sheaf validate|normalize|parse|project|references IN OUT"""

from __future__ import annotations

import argparse

from sheaf import service
from sheaf.operators import markdown, references
from sheaf.session import session
from sheaf.sources import sinks


def main(args: list[str] | None = None) -> int:
    """0, or 2 where validation finds a failure."""
    known = argparse.ArgumentParser(prog="sheaf", description=__doc__)
    known.add_argument("command", choices=("validate", "normalize", "parse", "project", "references"))
    known.add_argument("source")
    known.add_argument("out")
    given = known.parse_args(args)
    corpus = service.read(session(), given.source)
    if given.command == "parse":
        service.write(corpus, given.out)
    elif given.command == "normalize":
        markdown.canonical(corpus.blocks).write.mode("overwrite").parquet(given.out)
    elif given.command == "project":
        sinks.plain_markdown(corpus.blocks).write.mode("overwrite").parquet(given.out)
    elif given.command == "references":
        references.summary(corpus.citations()).write.mode("overwrite").parquet(given.out)
    else:
        found = corpus.findings()
        found.write.mode("overwrite").parquet(given.out)
        return 2 if found.filter("status = 'fail'").head(1) else 0
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
