"""Plans of downloads, extractions and trainings as DataFrames."""
