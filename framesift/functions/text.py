"""Names, identifiers and paths as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..constants import PROJECT_DIRECTORIES, REPOSITORY_DIRECTORIES, SCENE_CLASS_PREFIXES


def strip(column: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def blank_to_null(column: Column) -> Column:
    trimmed = strip(column)
    return F.when(trimmed != "", trimmed)


def safe_name(column: Column, *, trim: bool = False) -> Column:
    """Keep letters, digits, ``-`` and ``_``; anything else becomes ``_``."""
    value = strip(column) if trim else column
    cleaned = F.regexp_replace(value, r"[^\p{L}\p{N}_-]", "_")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit("instance"))


def class_of_scene(scene: Column) -> Column:
    """Class named by a scene-name prefix; null when no rule matches."""
    result = None
    for prefix, class_name in SCENE_CLASS_PREFIXES:
        hit = (scene == prefix) | scene.startswith(prefix + "_")
        result = F.when(hit, class_name) if result is None else result.when(hit, class_name)
    return result


def output_id(frame_id: Column, scene: Column, prefix: Column | None = None) -> Column:
    default = F.concat(scene, F.lit("_"))
    return F.concat(default if prefix is None else F.coalesce(prefix, default), frame_id)


def frame_name(index: Column) -> Column:
    """Six-digit frame id; longer numbers keep all their digits."""
    digits = index.cast("string")
    return F.when(F.length(digits) >= 6, digits).otherwise(F.lpad(digits, 6, "0"))


def two_digits(number: Column) -> Column:
    digits = number.cast("string")
    return F.when(F.length(digits) >= 2, digits).otherwise(F.lpad(digits, 2, "0"))


def stage_directory(class_id: Column, instance_id: Column) -> Column:
    return F.concat(F.format_string("class_%03d_", class_id), safe_name(instance_id))


def scene_name(class_name: Column, captured_at: Column, sequence: Column) -> Column:
    return F.concat_ws("_", class_name, F.date_format(captured_at, "yyyyMMdd_HHmm"), two_digits(sequence))


def session_id(scene: Column) -> Column:
    return F.concat(F.lit("session_"), scene)


def video_id(scene: Column) -> Column:
    return F.concat(scene, F.lit("_clip_01"))


def proposal_id(frame_id: Column, class_name: Column, detector: Column, number: Column) -> Column:
    return F.concat_ws("__", frame_id, class_name, detector, two_digits(number))


def valid_output_id(column: Column) -> Column:
    return column.rlike(r"^[A-Za-z0-9_-]+$")


def label_path(image: Column) -> Column:
    """Label file of an image: last ``images`` directory -> ``labels``, suffix ``.txt``.

    Null when no directory (or file) of the path is called ``images``.
    """
    parts = F.split(image, "/")
    size = F.size(parts)
    last = size - F.array_position(F.reverse(parts), "images") + 1
    swapped = F.transform(parts, lambda part, i: F.when(i + 1 == last, F.lit("labels")).otherwise(part))
    file_name = F.element_at(swapped, -1)
    stem = F.regexp_replace(file_name, r"(?<=.)\.[^.]+$", "")
    directories = F.slice(swapped, 1, size - 1)
    path = F.array_join(F.concat(directories, F.array(F.concat(stem, F.lit(".txt")))), "/")
    return F.when(F.array_contains(parts, "images"), path)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]+$", "")


def file_suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r".\.([^.]+)$", 1))


def range_start(spec: Column) -> Column:
    """Left part of ``START:END``; null when the text is no range."""
    text = F.trim(spec)
    start = F.substring_index(text, ":", 1)
    return F.when(F.contains(text, F.lit(":")) & (start != ""), start)


def range_end(spec: Column) -> Column:
    """Right part of ``START:END``; null means "to the last frame"."""
    text = F.trim(spec)
    return F.when(range_start(spec).isNotNull(), F.nullif(F.regexp_extract(text, r"^[^:]+:(.*)$", 1), F.lit("")))


def range_text(start: Column, end_before: Column, last_frame: Column) -> Column:
    """Readable range; wording of the two forms is fixed."""
    closed = F.concat(start, F.lit("–"), last_frame, F.lit("（包含末帧）"))
    open_end = F.concat(start, F.lit("–"), end_before, F.lit("（结束边界不包含）"))
    return F.when(end_before.isNull(), closed).otherwise(open_end)


def val_report_name(name: Column) -> Column:
    """Report name after a move to val; null unless it ends in ``_train_report.json``."""
    moved = F.regexp_replace(name, r"_train_report\.json$", "_val_report.json")
    return F.when(name.endswith("_train_report.json"), moved)


def relocated_path(path: Column, old_roots: Sequence[str], new_root: str, project_marker: str) -> Column:
    """New place of an absolute path of the project, null for paths that stay.

    Order of the rules: the last project marker, then a known root as prefix,
    then the last directory that is named like the root.
    """
    text = F.translate(path, "\\", "/")
    tail = F.regexp_extract(text, rf"(?s)^.*/{project_marker}/(.*)$", 1)
    result = F.when(F.contains(text, F.lit(f"/{project_marker}/")), F.concat(F.lit(f"{new_root}/{project_marker}/"), tail))
    for root in old_roots:
        prefix = root.rstrip("/") + "/"
        result = result.when(text.startswith(prefix), F.concat(F.lit(new_root + "/"), F.substring(text, len(prefix) + 1, 1 << 30)))
    for root in old_roots:
        name = root.rstrip("/").rsplit("/", 1)[-1]
        inner = F.regexp_extract(text, rf"(?s)^.*/{name}/(.*)$", 1)
        result = result.when(F.contains(text, F.lit(f"/{name}/")), F.concat(F.lit(new_root + "/"), inner))
    return F.when(path.startswith("/"), result)


def compatible_path(path: Column, repository: str, project: str) -> Column:
    """Resolve an absolute path of an older checkout to the present one.

    A known directory (data, datasets, ...) counts only directly below the
    repository name, the project name or ``projects/<project>``; the last such
    place wins.  Other absolute paths stay as they are.
    """
    repo_name, project_name = repository.rsplit("/", 1)[-1], project.rsplit("/", 1)[-1]
    known = [*PROJECT_DIRECTORIES, *REPOSITORY_DIRECTORIES]

    def placed(path: Column, parts: Column) -> Column:
        def part(i):
            return F.try_element_at(parts, i.cast("int"))

        def marker(i):
            below = (part(i - 1) == repo_name) | (part(i - 1) == project_name)
            return part(i).isin(known) & below

        places = F.filter(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), lambda i: F.coalesce(marker(i), F.lit(False)))

        def moved(place: Column) -> Column:
            rest = F.array_join(F.slice(parts, place, F.size(parts)), "/")
            root = F.when(part(place).isin(*PROJECT_DIRECTORIES), F.lit(project)).otherwise(F.lit(repository))
            inside = path.startswith(repository + "/") | path.startswith(project + "/")
            return F.when(inside | place.isNull() | ~path.startswith("/"), path).otherwise(F.concat(root, F.lit("/"), rest))

        return _bound(F.array_max(places), moved)

    return _bound(path, lambda p: _bound(F.split(p, "/"), lambda parts: placed(p, parts)))


def normal_path(path: Column) -> Column:
    """Path without empty, ``.`` and ``..`` parts; a relative path keeps leading ``..``."""

    def resolved(path: Column) -> Column:
        absolute = path.startswith("/")

        def step(done: Column, part: Column) -> Column:
            last = F.try_element_at(done, F.lit(-1))
            climbs = (part == "..") & last.isNotNull() & (last != "..")
            up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
            return F.when(climbs, up).when(absolute & (part == ".."), done).otherwise(F.concat(done, F.array(part)))

        parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
        kept = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
        # most paths hold no such part and are not taken apart
        plain = ~(path.contains("//") | path.contains("/.") | path.startswith(".") | path.endswith("/"))
        return F.when(plain | (path == ""), path).otherwise(F.concat(F.when(absolute, "/").otherwise(""), kept))

    return _bound(path, resolved)


def scene_identity(path: Column, repository: str | None = None, project: str | None = None) -> Column:
    """One spelling per scene: stripped, moved to the present checkout if one is given, and normalised."""
    path = normal_path(strip(path))
    return compatible_path(path, repository, project or repository) if repository else path


def owning_project(path: Column, repository: str, default_project: str) -> Column:
    """Project root of a path inside the repository, else the default project."""
    rest = F.split(F.substring(path, len(repository) + 2, 1 << 30), "/")
    second = F.try_element_at(rest, F.lit(2))
    is_project = (F.try_element_at(rest, F.lit(1)) == "projects") & F.try_element_at(rest, F.lit(3)).isin(*PROJECT_DIRECTORIES)
    named = F.when(is_project, F.concat(F.lit(repository + "/projects/"), second)).otherwise(F.lit(default_project))
    return F.when(path.startswith(repository + "/"), named).otherwise(F.lit(default_project))


def relative_path(path: Column, base: Column, inside: Column) -> Column:
    """``path`` seen from directory ``base``; outside paths stay absolute."""
    to, start = F.split(path, "/"), F.split(base, "/")
    same = F.zip_with(to, start, lambda a, b: a.eqNullSafe(b) & a.isNotNull())
    different = F.array_position(same, False)
    shared = F.when(different == 0, F.least(F.size(to), F.size(start))).otherwise(different - 1).cast("int")
    shared = F.least(shared, F.size(to), F.size(start))
    ups = F.array_repeat(F.lit(".."), F.size(start) - shared)
    rest = F.slice(to, shared + 1, F.greatest(F.size(to) - shared, F.lit(0)))
    joined = F.array_join(F.concat(ups, rest), "/")
    return F.when(inside, F.coalesce(F.nullif(joined, F.lit("")), F.lit("."))).otherwise(path)


def relocated_relative(path: Column, base: Column, old_roots: Sequence[str], new_root: str, project_marker: str) -> Column:
    """``relocated_path`` seen from directory ``base`` of the document that holds the path."""
    moved = relocated_path(path, old_roots, new_root, project_marker)
    return _bound(moved, lambda m: F.when(m.isNotNull(), relative_path(m, base, F.lit(True))))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def rewrite_json_paths(document: Column, rewrite) -> tuple[Column, Column]:
    """Rewrite path strings that are values anywhere in JSON text.

    Returns the new text and the number of changed strings.  Escaped backslashes and
    quotes are parked as control characters, which valid JSON never holds in the raw, so
    the text splits at its quotes: every second piece is a string, and one followed by a
    colon is an object key and stays.  Nesting depth and schema do not matter.
    """
    parked = F.replace(F.replace(document, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    parts = F.split(parked, '"')

    def restored(piece):
        return F.replace(F.replace(piece, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))

    def renew(piece, i):
        is_value = (i % 2 == 1) & ~F.coalesce(F.try_element_at(parts, i + 2).rlike(r"^\s*:"), F.lit(False))
        candidate = is_value & (piece.startswith("/") | piece.startswith("\\"))
        plain = F.when(candidate, F.get_json_object(F.concat(F.lit('["'), restored(piece), F.lit('"]')), "$[0]"))
        encoded = F.to_json(F.array(_bound(plain, rewrite)))  # [null] for strings that stay
        moved = _bound(encoded, lambda e: F.when(e != "[null]", F.substring(e, F.lit(3), F.length(e) - 4)))
        return F.struct(moved.alias("new"), restored(piece).alias("old"))

    pieces = F.transform(parts, renew)
    text = F.array_join(F.transform(pieces, lambda p: F.coalesce(p["new"], p["old"])), '"')
    changes = F.size(F.filter(pieces, lambda p: p["new"].isNotNull()))
    return text, changes
