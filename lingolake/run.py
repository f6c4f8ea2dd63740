"""Command line: ``python -m lingolake.run detect --phenomenon passive [--lang en] [--mixed] [--view v ...] -- INPUT OUTPUT``.

INPUT is CoNLL-U; OUTPUT gets the annotations as Parquet.  The other steps of a plan need a model, which is the caller's.
"""

from __future__ import annotations

import argparse


def main(arguments: list[str] | None = None) -> None:
    from .operators import annotate, layers
    from .session import session

    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("command", choices=["detect", "parse", "real-word-errors", "spelling", "discourse-units", "coreference"])
    parser.add_argument("--phenomenon", choices=sorted(annotate.REGISTRY))
    parser.add_argument("--lang", "--language", dest="lang")
    parser.add_argument("--mixed", action="store_true")
    parser.add_argument("--view", nargs="*")
    parser.add_argument("paths", nargs=2, metavar=("INPUT", "OUTPUT"))
    given = parser.parse_args(arguments)
    if given.command != "detect":
        parser.error(f"{given.command} needs a model: see lingolake.operators.models")
    if not given.phenomenon:
        parser.error("--phenomenon is needed")
    sentences = layers.read_conllu(session(), given.paths[0])
    if given.view:
        sentences = sentences.filter(sentences["view"].isin(*given.view))
    annotate.detect(sentences, given.phenomenon, lang=given.lang, mixed=given.mixed).write.parquet(given.paths[1])


if __name__ == "__main__":
    main()
