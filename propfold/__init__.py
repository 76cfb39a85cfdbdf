"""propfold: fold property rows of events and users into typed wide tables."""
