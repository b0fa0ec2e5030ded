from tidewell.functions.calendar import compact_date, iso_date, week_friday, week_monday
from tidewell.functions.keys import batch_dir, batch_file, batch_path, batch_stem
from tidewell.functions.status import status_label

__all__ = [
    "batch_dir", "batch_file", "batch_path", "batch_stem", "compact_date", "iso_date",
    "status_label", "week_friday", "week_monday",
]
