"""Where rows come from and go to: scans, images, OCR and vision providers, files."""
