"""techmine: Spark-native mining of technology mentions in scholarly works.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver except bounded metadata (partition counts, size checks).
"""

from techmine.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
