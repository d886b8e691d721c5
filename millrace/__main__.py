"""``python -m millrace fact|dimension|manifest``, also for spark-submit."""

from __future__ import annotations

import argparse

from millrace import DIMENSION, FACT, Options, build_session, run_load, run_manifest


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace")
    runs = parser.add_subparsers(dest="run", required=True)
    for name in ("fact", "dimension"):
        load = runs.add_parser(name)
        for path in ("spec", "raw", "output", "errors", "audit"):
            load.add_argument(path)
        load.add_argument("--data-files", type=int)
        load.add_argument("--log-files", type=int)
        load.add_argument("--strict", action="store_true")
        load.add_argument("--log-required", action="store_true")
        load.add_argument("--match", choices=("exact", "contains"), default="exact")
        load.add_argument("--rescan", action="store_true")
        load.add_argument("--keep", choices=("first", "last"))
        load.add_argument("--system", action="append", default=[], metavar="NAME or FOLDER=NAME")
        load.add_argument("--reject-table")
        load.add_argument("--history", action="store_true")
        load.add_argument("--close-missing", action="store_true")
        load.add_argument("--dimension-key", action="append", metavar="DIMENSION=COLUMN,COLUMN")
        load.add_argument("--doubled-keys")
    manifest = runs.add_parser("manifest")
    manifest.add_argument("output")
    manifest.add_argument("folders", nargs="+", metavar="NAME=FOLDER")
    return parser.parse_args(argv)


def named_folders(texts: list[str]) -> list[tuple[str, str]]:
    """``NAME=FOLDER`` arguments as pairs; a name may come twice."""
    for text in texts:
        if not text.partition("=")[1]:
            raise SystemExit(f"manifest folders are NAME=FOLDER, not {text!r}")
    return [tuple(text.split("=", 1)) for text in texts]


def source_systems(texts: list[str]) -> str | dict[str, str] | None:
    """One name for all rows, or a name for each folder."""
    if len(texts) == 1 and "=" not in texts[0]:
        return texts[0]
    if not all("=" in text for text in texts):
        raise SystemExit(f"source systems are one NAME, or FOLDER=NAME each, not {texts}")
    return dict(text.rsplit("=", 1) for text in texts) or None


def dimension_keys(texts: list[str] | None) -> dict[str, list[str]] | None:
    """``DIMENSION=COLUMN,COLUMN`` arguments; without columns the first one counts."""
    if texts is None:
        return None
    pairs = [text.partition("=") for text in texts]
    return {name: [c.strip() for c in keys.split(",") if c.strip()] for name, _, keys in pairs}


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    folders = named_folders(args.folders) if args.run == "manifest" else []
    spark = build_session(f"millrace-{args.run}")
    if args.run == "manifest":
        run_manifest(spark, folders, args.output)
        return
    options = Options(
        data_files=args.data_files,
        log_files=args.log_files,
        strict=args.strict,
        log_required=args.log_required,
        match=args.match,
        stage=not args.rescan,
        keep=args.keep,
        systems=source_systems(args.system),
        reject_table=args.reject_table,
        history=args.history,
        close_missing=args.close_missing,
        dimension_keys=dimension_keys(args.dimension_key),
        doubled_keys=args.doubled_keys,
    )
    preset = FACT if args.run == "fact" else DIMENSION
    result = run_load(
        spark, preset, args.spec, args.raw, args.output, args.errors, args.audit, options
    )
    print(result)


if __name__ == "__main__":
    main()
