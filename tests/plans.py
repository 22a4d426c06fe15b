"""Reading physical plans."""

import contextlib
import io


def explained(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def files_read(df):
    """The files a query touches, out of those its table lists."""
    return {row[0] for row in df.select("_metadata.file_path").distinct().collect()}
