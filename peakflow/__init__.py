"""peakflow: quality control, normalisation and quantification of mass-spectrometry peak tables on Spark."""
