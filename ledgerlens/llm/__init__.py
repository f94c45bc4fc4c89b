"""Training-data operators. Nothing outside this folder imports it, apart from the two entry files at the top."""
